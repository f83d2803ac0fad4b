import hashlib
import random
import re


from tallyglass.llm import pii
from tests.llm.helpers import empty_docs, frame, odd_docs, odd_rows, with_clashes

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(digits[::-1]):
        n = int(d) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


TEXTS = [
    "a@b.c@d.e x@@y.z @a.b .@-.-", "a@b", "x.y%z+1-2@mail-1.example.co.uk.", "é@b.c", "1.2.3.4 256.1.1.1 1.2.3.4.5 001.2.3.255 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112", "+1 (650) 555-0100 +4915112345678 + 1234567890 +1---", "00000000000000",
    "call +1 (650) 555-0100.4111111111111111@x.y 10.0.0.1@h.i", "9" * 3000, "@" * 500 + "a" * 500 + "@b.c", "+1" + " " * 500,
]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab0123456789@@..-+ ( )%é") for _ in range(rng.randrange(60))) for _ in range(5000)]
    for text in texts:
        assert [(a, k, b) for a, b, k in pii.base_spans(text)] == brute(text), text


def test_long_runs_are_linear():
    pii.mentions("1" * 200_000 + " " + "a." * 100_000 + "@" * 10_000 + " " + "1-" * 100_000)


def spans_text(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query_columns(spark):
    rows = odd_rows() + [(50 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    docs = with_clashes(frame(spark, rows), "mentions", "added", "spans", "pattern")
    got = pii.find(docs).collect()
    assert len(got) == len(rows)
    want = {}
    for doc, text, *_ in rows:
        want.setdefault(doc, []).append(brute(text or ""))
    for r in got:
        base = next(b for b in want[r.doc_id] if hashlib.sha256(spans_text(b).encode()).hexdigest() == r.base_sha256)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(filter(None, spans_text(base).split(","))) <= set(r.spans.split(","))


def test_context_discovers_and_leaves_clean_text_alone(spark):
    rows = [(i, f"note {i}: please write mail to user{i}@host.example today", None, None, 0) for i in range(8)]
    rows.append((90, "others please write mail to user77(at)host.example today", None, None, 0))
    rows.append((91, "the year 1999 had 365 days and room B1204 was free", None, None, 0))
    rows.append((92, None, None, None, 0))
    got = {r.doc_id: r for r in pii.find(frame(spark, rows)).collect()}
    text = rows[8][1]
    start = text.index("user77")
    assert got[91].spans == "" and got[92].spans == ""
    found = got[90].spans
    assert found in ("", f"context:{start}:{start + len('user77(at)host.example')}")
    rows[8] = (90, "others please write mail to user7777(at)host.example today", None, None, 0)
    got = {r.doc_id: r for r in pii.find(frame(spark, rows)).collect()}
    assert got[90].spans == f"context:{start}:{start + len('user7777(at)host.example')}"
    assert all(got[i].spans.startswith("email:") and "," not in got[i].spans for i in range(8))


def test_confidence_equals_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        left = f"{rng.choice('pqr')} {rng.choice('xyz')}"
        seed = rng.random() < 0.5
        name = f"n{rng.randrange(30)}@h.example" if seed else f"id-{rng.randrange(100, 130)}"
        rows.append((i, f"zzz {left} {name} end", None, None, 0))
    scanned = pii.scan(frame(spark, rows)).cache()
    got = {r.pattern: r.confidence for r in pii.trusted_patterns(scanned, confidence=0.0).collect()}
    edges = {}
    for r in scanned.collect():
        for m in r.mentions:
            if m.pattern:
                n, s = edges.get((m.pattern, m.instance), (0, False))
                edges[m.pattern, m.instance] = (n + 1, s or m.kind is not None)
    seeds = {p: sum(s for (q, _), (_, s) in edges.items() if q == p) for p, _ in edges}
    edges = {e: v for e, v in edges.items() if seeds[e[0]] >= pii.MIN_SEEDS}
    sure = {}
    for (_, i), (_, s) in edges.items():
        sure[i] = max(sure.get(i, 0.0), float(s))
    for _ in range(pii.ROUNDS):
        conf = {}
        for p in {p for p, _ in edges}:
            mine = [(n, sure[i]) for (q, i), (n, _) in edges.items() if q == p]
            conf[p] = sum(n * s for n, s in mine) / sum(n for n, _ in mine)
        sure = {}
        for (p, i), (_, s) in edges.items():
            sure[i] = max(sure.get(i, 0.0), 1.0 if s else conf[p])
    assert got.keys() == conf.keys() and len(got) > 3
    assert all(abs(got[p] - conf[p]) < 1e-9 for p in conf)


def test_empty_table(spark):
    assert pii.find(empty_docs(spark)).count() == 0


def test_context_finds_any_shape(spark):
    """After a sure context the shape does not matter; after an unsure one plain words stay alone."""
    rows = [(i, f"note {i}: please write mail to user{i}@host.example today", None, None, 0) for i in range(40)]
    hidden = {
        90: "user77(at)host.example", 91: "jane.doe(at)host.example", 92: "@jane_doe", 93: "650 555 0100",
        94: "x1" * 50, 95: "12 34 56", 96: "650) 555-0100",
    }
    rows += [(i, f"others please write mail to {h}, or not", None, None, 0) for i, h in hidden.items()]
    rows += [(100 + i, f"you can ask for a{i}@host.example now", None, None, 0) for i in range(4)]
    rows += [(110 + i, f"you can ask for {w} now", None, None, 0) for i, w in enumerate("bread milk more nothing".split())]
    rows += [(120 + i, f"send it mailto:b{i}@host.example now", None, None, 0) for i in range(20)]
    rows += [(150, "send it mailto:carl(at)host.example now", None, None, 0), (151, "mail to nobody", None, None, 0)]
    got = {r.doc_id: r.spans for r in pii.find(frame(spark, rows).repartition(4)).collect()}
    hidden[150] = "carl(at)host.example"
    texts = {r[0]: r[1] for r in rows}
    for i, h in hidden.items():
        start = texts[i].index(h)
        assert got[i] == f"context:{start}:{start + len(h)}", (i, got[i])
    assert all(got[110 + i] == "" for i in range(4)) and got[151] != got[150]
    assert all(got[i].startswith("email:") and "," not in got[i] for i in (*range(40), *range(100, 104), *range(120, 140)))


def test_followers_are_linear_and_touch_no_base_span():
    bits = bytes([255]) * (1 << pii.SLOT_BITS - 3)
    pii.followers("1 " * 50_000 + "a." * 50_000 + "(" * 50_000 + " " + "9" * 50_000 + " x", bits)
    for text in TEXTS:
        for m in pii.followers(text, bits):
            assert not any(a < m["end"] and m["start"] < b for a, b, _ in pii.base_spans(text))


def test_long_runs_of_zeros_are_addresses():
    assert pii.base_spans("0" * 5000 + "1.1.1.1") == [(0, 5007, 1)]
    assert pii.base_spans("0" * 5000 + ".0001.255.00256") == [] and pii.base_spans("9" * 5000 + ".1.1.1") == []


def test_found_identifiers_make_new_patterns_sure(spark):
    """Identifiers found behind a seeded context carry over to a second context, and that one finds others."""
    rows = [(i, f"note {i}: please contact agent user{i}@host.example today", None, None, 0) for i in range(60)]
    rows += [(100 + i, f"then please contact agent ID-{4000 + i} today", None, None, 0) for i in range(12)]
    rows += [(200 + i, f"records show badge number ID-{4000 + i} there", None, None, 0) for i in range(12)]
    rows += [(300 + i, f"records show badge number ID-{7000 + i} there", None, None, 0) for i in range(2)]
    rows += [(400 + i, f"we sold about roughly {1000 + i} loaves", None, None, 0) for i in range(20)]
    got = {r.doc_id: r.spans for r in pii.find(frame(spark, rows).repartition(4)).collect()}
    texts = {r[0]: r[1] for r in rows}
    for i in (*range(100, 112), *range(200, 212), 300, 301):
        start = texts[i].index("ID-")
        assert got[i] == f"context:{start}:{start + 7}", (i, got[i])
    assert all(got[400 + i] == "" for i in range(20))
