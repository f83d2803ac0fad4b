"""Tables behind model decisions (runs, versions, aliases) in one folder, append-only.

Versions and alias changes are commits of one log (``commitlog``): a writer reads what is committed, decides, and
commits under the next number; if another writer took that number, it reads and decides again. So parallel writers get
different versions, and a promotion sees every promotion before it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.operators import registry
from tallyglass.sources import sinks
from tallyglass.sources.commitlog import CommitLog, list_files

VERSION_SCHEMA = "model string, version int, run_id string, uri string, description string, ts timestamp"
ALIAS_SCHEMA = "model string, version int, alias string, source string, description string, ts timestamp"


CHANGE_SCHEMA = f"versions array<struct<{VERSION_SCHEMA}>>, aliases array<struct<{ALIAS_SCHEMA}>>"


def _stamp(ts: dt.datetime | None) -> str:
    return (ts or dt.datetime.now()).astimezone().isoformat(timespec="microseconds")


@dataclass(frozen=True)
class ModelStore:
    """Any number of writers; readers see whole commits."""

    spark: SparkSession
    root: str
    _seen: dict[int, dict] = field(default_factory=dict, repr=False, compare=False)

    def _log(self) -> CommitLog:
        return CommitLog(f"{self.root}/changes", self.spark)

    def _changes(self, name: str, schema: str) -> DataFrame:
        if not list_files(f"{self.root}/changes"):
            return self.spark.createDataFrame([], schema)
        changes = self.spark.read.schema(CHANGE_SCHEMA).json(f"{self.root}/changes")
        return changes.select(F.explode(name).alias("c")).select("c.*")

    def _committed(self) -> list[dict]:
        """All commits in order; those read before come from memory, since a commit never changes."""
        log = self._log()
        self._seen.update(log.entries(max(self._seen, default=0)))
        return [self._seen[v] for v in sorted(self._seen)]

    def runs(self) -> DataFrame:
        empty = self.spark.createDataFrame([], sinks.RUN_SCHEMA)
        empty.write.mode("ignore").parquet(f"{self.root}/runs")
        return self.spark.read.schema(sinks.RUN_SCHEMA).parquet(f"{self.root}/runs")

    def versions(self) -> DataFrame:
        return self._changes("versions", VERSION_SCHEMA)

    def aliases(self) -> DataFrame:
        return self._changes("aliases", ALIAS_SCHEMA)

    def log_run(self, run_id: str, run_name: str, **groups) -> None:
        sinks.append_runs(sinks.run_rows(self.spark, run_id, run_name, **groups), f"{self.root}/runs")

    def _next_version(self, model: str) -> int:
        return 1 + max((v["version"] for e in self._committed() for v in e.get("versions", []) if v["model"] == model), default=0)

    def _save(self, model: str, run_id: str, fitted: PipelineModel | None) -> str:
        """The pipeline's folder, written ahead of the commit that names it."""
        uri = f"{self.root}/models/{model}/{run_id}-{uuid.uuid4().hex}"
        if fitted is not None:
            sinks.save_pipeline(fitted, uri)
        return uri

    def _commit(self, decide: Callable[[], dict]) -> dict:
        """Commit what ``decide`` gives; it is asked again when another writer was faster."""
        kept: dict = {}

        def build(_: int) -> dict:
            kept.clear()
            kept.update(decide())
            return kept

        self._log().commit(build)
        return kept

    def register(
        self, model: str, run_id: str, fitted: PipelineModel | None = None, description: str = "", ts: dt.datetime | None = None
    ) -> int:
        """Next version number of a model (created on first use); the fitted pipeline is saved with it."""
        uri = self._save(model, run_id, fitted)
        at = _stamp(ts)

        def decide() -> dict:
            version = self._next_version(model)
            return {"versions": [dict(model=model, version=version, run_id=run_id, uri=uri, description=description, ts=at)]}

        return self._commit(decide)["versions"][0]["version"]

    def set_alias(
        self, model: str, version: int, alias: str, description: str = "", source: str = "alias", ts: dt.datetime | None = None
    ) -> None:
        at = _stamp(ts)
        change = dict(model=model, version=version, alias=alias, source=source, description=description, ts=at)
        self._commit(lambda: {"aliases": [change]})

    def transition_stage(self, model: str, version: int, stage: str, description: str = "") -> None:
        self.set_alias(model, version, registry.STAGE_ALIASES.get(stage, stage.lower()), description)

    def lookup(self, model: str, alias: str = "champion") -> int | None:
        """Version behind an alias, or behind the tag of that name, or None."""
        row = registry.resolve(self.aliases().filter(F.col("model") == model), alias).first()
        return row["version"] if row else None

    def load(self, model: str, alias: str = "champion") -> PipelineModel | None:
        version = self.lookup(model, alias)
        if not version:
            return None
        known = self.versions().filter((F.col("model") == model) & (F.col("version") == version))
        return sinks.load_pipeline(known.first()["uri"])

    def champion_metrics(self, model: str) -> dict | None:
        aliases = self.aliases().filter(F.col("model") == model)
        row = registry.champion_metrics(aliases, self.versions(), self.runs()).first()
        return row.asDict() if row else None

    def promote(self, model: str, run_id: str, auc: float, fitted: PipelineModel | None = None) -> tuple[int, str]:
        """Register the run, in one commit with its alias: champion when it is the first or strictly better, else challenger."""
        uri = self._save(model, run_id, fitted)

        def decide() -> dict:
            version = self._next_version(model)
            best = self.champion_metrics(model)
            better = best is None or best["auc"] is None or auc > best["auc"]
            at = _stamp(None)
            alias = "champion" if better else "challenger"
            return {
                "versions": [dict(model=model, version=version, run_id=run_id, uri=uri, description="", ts=at)],
                "aliases": [dict(model=model, version=version, alias=alias, source="alias", description="", ts=at)],
            }

        change = self._commit(decide)
        return change["versions"][0]["version"], change["aliases"][0]["alias"]
