import random
import string
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyglass.llm import packing, rans
from tallyglass.llm.textids import BareUnits, SpacedUnits, is_latin
from tests.llm.helpers import empty_docs, frame, odd_docs, odd_rows, prose, with_clashes

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "", " ", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "a\n\nb", "\na\n", "a\t b", "a  b", "a 　b", "it's I'll  don't\n'tis",
    "x\x1c y\x1d\nz", "é é İstanbul ΑΣ ΣΑΣ.", "漢字 かな\n한글", "<|endoftext|> <|startoftext|>a", "see <|endoftext|> here",
    "<|ENDOFTEXT|> <|StartOfText|>", "a\n<|endoftext|><|endoftext|>  b <|startoftext|>\n", " <|endoftext|>", "x<|endoftext|", "K<|endoftext|>İ", "1234 5 67,8.9!! ?? #$%\r\n\r\nend  ", "a b c\u0085 d",
    "\U0001d504 \U0001f600\U0001f600 ok", "word" * 200,
]


def plain_ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_units_give_the_ids_of_whole_texts(sf_dir):
    import pyarrow.parquet as pq

    texts = TRICKY + pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column("text").to_pylist()
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab'.9 \n\t\r é") for _ in range(rng.randrange(30))) for _ in range(2000)]
    for kind, path in ((SpacedUnits, BYTE), (BareUnits, WORD)):
        tokenizer = Tokenizer.from_file(path)
        units = kind(path)
        for text in texts:
            got = np.frombuffer(units.ids(text), "<u4").tolist()
            assert got == tokenizer.encode(text, add_special_tokens=False).ids, (kind, text[:80])


def check_pieces(pieces, rows):
    """Every id of every row lies in one piece; windows are gapless and at most 1024 long."""
    want = defaultdict(list)
    for doc, text, *_ in rows:
        want[doc].append(plain_ids(BYTE, text or "") + [0])
    windows, docs = defaultdict(list), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        assert p.length > 0 and p.length * 4 == len(p.ids)
        windows[p.sequence_id].append(p)
        sources = [ids for ids in want[p.doc_id] if len(ids) == p.doc_tokens]
        assert any(np.array(ids[p.start : p.start + p.length], "<u4").tobytes() == bytes(p.ids) for ids in sources)
        docs[p.doc_id][p.start] += p.length
    for doc, texts in want.items():
        assert sum(docs[doc].values()) == sum(map(len, texts))
    padding = 0
    for members in windows.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding, sum(len(ids) for texts in want.values() for ids in texts)


def test_every_id_once_and_no_padding(spark):
    rng = random.Random(2)
    rows = odd_rows() + [(100 + i, prose(rng, rng.randrange(1, 900)), "en", "s", 0) for i in range(200)]
    padding, total = check_pieces(packing.pack(frame(spark, rows)).collect(), rows)
    assert padding <= 0.001 * total


def test_rule_chooses_the_least_sum_of_squares():
    rng = random.Random(4)
    levels = packing.LevelArray(16, 0)
    for _ in range(500):
        size = rng.randrange(1, 16)
        cost = {}
        for level in range(0, 17 - size):
            if level and not levels.count[level]:
                continue
            after = levels.count.copy()
            if level:
                after[level] -= 1
            if level + size < 16:
                after[level + size] += 1
            cost[level] = int((after**2).sum())
        chosen = levels.level_for(size)
        assert cost[chosen] == min(cost.values()), (size, chosen, cost)
        levels.place((0, 0, size, b"", size), size)
        assert all(len(o) == c for o, c in zip(levels.open, levels.count))


def test_packing_digest_clashes_and_empty(spark):
    docs = with_clashes(odd_docs(spark), "start", "ids", "sequence_id")
    pieces = packing.pack(docs)
    digest = {(p.sequence_id, p.offset): p.ids_crc32 for p in packing.pieces_digest(pieces).collect()}
    assert digest == {(p.sequence_id, p.offset): zlib.crc32(bytes(p.ids)) for p in pieces.collect()}
    assert packing.pack(empty_docs(spark)).count() == 0


def test_rans_block_round_trip():
    rng = np.random.default_rng(1)
    for n, symbols in ((0, 3), (1, 1), (5, 2), (1024, 50), (50_000, 49_000)):
        data = np.minimum(rng.geometric(0.01, n) - 1, symbols - 1) if n else np.zeros(0, np.int64)
        counts = np.bincount(data, minlength=symbols)
        code = rans.Table(rans.scaled_frequencies(counts))
        assert not n or int(code.freq.sum()) == 1 << rans.SCALE_BITS
        lengths = [n // 2, n - n // 2]
        block = rans.block_bytes([7, -1], lengths, data, code)
        ids, sizes, back = rans.parse_block(block, zlib.crc32(block), code)
        assert ids.tolist() == [7, -1] and sizes.tolist() == lengths and (back == data).all()
        if n == 50_000:
            assert len(block) < n * 2
        if n:
            with_error = bytearray(block)
            with_error[-1] ^= 1
            try:
                rans.parse_block(bytes(with_error), zlib.crc32(block), code)
            except ValueError:
                continue
            raise AssertionError("damage not noticed")


def test_rans_query_equals_plain_ids(spark, tmp_path):
    rng = random.Random(6)
    rows = odd_rows() + [(1000 - i, prose(rng, rng.randrange(1, 300)), "en", "s", 0) for i in range(100)]
    with_clashes(frame(spark, rows), "part", "ids", "n_tokens").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in rans.op4_rans(spark, str(tmp_path)).collect())
    at, left = 0, list(got)
    for (doc, text, *_) in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain_ids(WORD, text or "") + [2]
        want = (at, doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert want in left, (want, got[:3])
        left.remove(want)
        at += len(ids)
    assert not left


def test_rans_empty_table(spark, tmp_path):
    empty_docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert rans.op4_rans(spark, str(tmp_path)).count() == 0


def test_is_latin_agrees_with_the_largest_character():
    for text in [t for t in TRICKY if t] + ["\xff", "Ā", "\ud800"]:
        assert is_latin(text) == (max(text) <= "\xff")


def test_memo_is_bounded_and_keeps_ids(monkeypatch):
    from tallyglass.llm import textids

    monkeypatch.setattr(textids, "MEMO_UNITS", 8)
    rng = random.Random(3)
    units = SpacedUnits(BYTE)
    for _ in range(50):
        text = prose(rng, 30) + ". end, A-1"
        assert np.frombuffer(units.ids(text), "<u4").tolist() == plain_ids(BYTE, text)
        for memo in (units.whole, units.first, units.rest):
            assert len(memo) <= 4 and len(memo.older) <= 4


def test_a_worker_keeps_the_last_stage_only():
    from tallyglass.llm.common import kept

    made = []
    for key in ("a", "a", "b", "a"):
        assert kept(key, lambda key=key: made.append(key) or key) == key
    assert made == ["a", "b", "a"]


def test_batches_of_pieces_are_small(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(packing, "FLUSH_IDS", 2048)
    monkeypatch.setattr(packing, "TaskContext", type("Here", (), {"get": staticmethod(lambda: _First)}))
    import pyarrow as pa

    rows = [(i, prose(rng, 400)) for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["doc_id", "text"])
    got = list(packing.pack_split(iter([batch]), BYTE, 0, 1024))
    lengths = [sum(b.column("length").to_pylist()) for b in got]
    assert max(lengths) <= 2048 + 1024 and sum(lengths) == sum(len(plain_ids(BYTE, t)) + 1 for _, t in rows)


class _First:
    @staticmethod
    def partitionId():
        return 0


def test_batches_of_texts_are_small(spark):
    """Long texts reach the Python workers a few megabytes at a time, and not ten thousand at once."""
    from pyspark.sql import functions as F

    from tallyglass.llm import langid, ngramjoin
    from tallyglass.llm.common import BATCH_BYTES, BATCH_SETTING

    def largest(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"))
    for operator in (packing.pack, ngramjoin.scan, lambda rows: langid.identify(rows, {"en": "some words of it"})):
        spark.conf.set(BATCH_SETTING, "64m")
        operator(docs)
        assert docs.mapInArrow(largest, "size bigint").agg(F.max("size")).first()[0] <= BATCH_BYTES + 200_000
    spark.conf.set(BATCH_SETTING, "1m")
    packing.pack(docs)
    assert spark.conf.get(BATCH_SETTING).startswith(("1m", str(1 << 20)))


def test_memos_of_lines_are_small():
    units = SpacedUnits(BYTE)
    assert units.first.most < units.rest.most and units.whole.most < units.rest.most
    units.first.most = 8
    texts = [f"Word{i} and more\nLine{i} too" for i in range(50)] * 2
    assert [np.frombuffer(units.ids(t), "<u4").tolist() for t in texts] == [plain_ids(BYTE, t) for t in texts]
    assert len(units.first) + len(units.first.older) <= 8


def test_punctuation_behind_words_spares_the_whole_tokenizer(monkeypatch):
    """Any run of ASCII punctuation but an apostrophe is one pre-token, encoded once for all words before it."""
    marks = [m for m in string.punctuation if m != "'"] + ["&&&", ".***", ",%%%", "_(", "-_-", "|", '."', "!?#"]
    text = " ".join(f"{w}{m}" for w in ("hent", "Onli", "Stra\u00dfe", "\u0416\u0423\u041a") for m in marks)
    for kind, path in ((SpacedUnits, BYTE), (BareUnits, WORD)):
        units, whole = kind(path), []
        memos = [m for m in vars(units).values() if isinstance(m, dict)]
        for memo in memos:
            real = memo.encode
            monkeypatch.setattr(memo, "encode", lambda t, real=real: whole.append(t) or real(t))
        assert np.frombuffer(units.ids(text), "<u4").tolist() == plain_ids(path, text)
        assert not [t for t in whole if t.strip(string.punctuation) and t.isascii()]
    for tricky in ("dog's.", "dogs'.", "dog'll!", "it's", "a'", "x'&&&", "A-1 b_c d.e", "a\u0301. e\u0338="):
        for kind, path in ((SpacedUnits, BYTE), (BareUnits, WORD)):
            assert np.frombuffer(kind(path).ids(tricky), "<u4").tolist() == plain_ids(path, tricky)
