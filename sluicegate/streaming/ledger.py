"""What each micro-batch was routed with, written before the batch.

Rules and schemas are read anew for every micro-batch, so a batch that is replayed after a failure could
meet others than its first attempt did, and send messages it has sent already to other topics.  The
ledger has a row per query and batch that names the versions of its first attempt; a version is
stored once, under a digest of its content.  A replay reads its row and routes with the same versions."""

import hashlib
import json
import time
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicegate.operators.rules import Rules
from sluicegate.operators.schemas import SCHEMA_COLUMNS, Registry, resolve_schema

ENTRY = "rules string, schemas string, reader_schema string, started double"
RULES = "rules string"
MARK = "mark string"


def store_row(spark, path, row, schema):
    """One row as the only file of a folder: it is there as a whole or not at all."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(path)


def stored_row(spark, path, schema):
    try:
        return spark.read.schema(schema).parquet(path).head()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def table_digest(table):
    """A text that tells tables with different rows apart, whatever their order."""
    row = F.xxhash64(*table.columns)
    other = F.xxhash64(F.lit("other"), *table.columns)  # 128 bits a row
    [found] = table.agg(
        F.count("*").alias("n"),
        *[F.sum(h.cast("decimal(38,0)")).alias(f"s{i}") for i, h in enumerate((row, other))],
        *[F.bit_xor(h).alias(f"x{i}") for i, h in enumerate((row, other))],
    ).collect()
    return hashlib.sha256(json.dumps([str(v) for v in found]).encode()).hexdigest()


@dataclass(frozen=True)
class Settled:
    """What a micro-batch is routed with; ``started``: the clock at its first attempt."""

    schemas: object  # a Registry, or None for a router with one reader schema
    rules: Rules
    config: object
    started: float
    replayed: bool


@dataclass
class Ledger:
    """The ledger under a folder that all executors share, best beside the query's checkpoint.

    It grows by a row per batch and by a copy of each version of rules and schemas."""

    path: str
    clock: object = time.time
    _kept: dict = field(default_factory=dict)  # what the last batch used, by version

    def _entry(self, run, batch_id):
        return f"{self.path}/batches/run={run}/batch_id={batch_id}"

    def settle(self, spark, run, batch_id, load_schemas, load_rules, config):
        """The versions of the batch's first attempt; at the first attempt, those of now."""
        entry = stored_row(spark, self._entry(run, batch_id), ENTRY)
        if entry is None:
            rules, schemas, reader = Rules.of(load_rules()), None, None
            if config.schema_mode == "reader":
                _, reader = resolve_schema(spark, load_schemas(), config)
            else:
                schemas = self._store_schemas(load_schemas())
            started = float(self.clock())
            row = (self._store_rules(spark, rules), schemas, reader, started)
            store_row(spark, self._entry(run, batch_id), row, ENTRY)
            replayed = False
        else:
            rules = self._rules(spark, entry.rules)
            schemas, reader, started, replayed = entry.schemas, entry.reader_schema, entry.started, True
        if reader is not None:
            config = replace(config, reader_schema=reader)
        registry = None if schemas is None else self._registry(spark, schemas, config)
        return Settled(registry, rules, config, started, replayed)

    def begun(self, spark, run, batch_id, sink):
        """Whether an earlier attempt of the batch began to write to a sink; notes that this one does."""
        path = f"{self.path}/sinks/run={run}/batch_id={batch_id}/sink={sink}"
        if stored_row(spark, path, MARK) is not None:
            return True
        store_row(spark, path, ("begun",), MARK)
        return False

    def _keep(self, kind, version, value):
        self._kept[kind] = (version, value)
        return value

    def _held(self, kind, version):
        found = self._kept.get(kind)
        return found[1] if found and found[0] == version else None

    def _store_rules(self, spark, rules):
        text = json.dumps(rules.pairs)
        version = hashlib.sha256(text.encode()).hexdigest()
        path = f"{self.path}/rules/{version}"
        if self._held("rules", version) is None and stored_row(spark, path, RULES) is None:
            store_row(spark, path, (text,), RULES)
        self._keep("rules", version, rules)
        return version

    def _rules(self, spark, version):
        held = self._held("rules", version)
        if held is None:
            text = stored_row(spark, f"{self.path}/rules/{version}", RULES).rules
            held = self._keep("rules", version, Rules.of(json.loads(text)))
        return held

    def _store_schemas(self, table):
        """The version of a schema table, stored if it is new."""
        if isinstance(table, Registry):
            table = table.table.selectExpr(
                "cast(null as string) subject", "cast(0 as bigint) version", "schema_id", "schema_json"
            )
        names = [c.split()[0] for c in SCHEMA_COLUMNS.split(", ")]
        table, spark = table.select(*names), table.sparkSession
        version = table_digest(table)
        path = f"{self.path}/schemas/{version}"
        if self._held("schemas", version) is None and stored_row(spark, f"{path}/done", MARK) is None:
            table.write.mode("overwrite").parquet(f"{path}/table")
            store_row(spark, f"{path}/done", ("done",), MARK)
        return version

    def _registry(self, spark, version, config):
        """The schemas of a version, checked and read once for all batches that use it."""
        held = self._held("schemas", version)
        if held is None:
            table = spark.read.schema(SCHEMA_COLUMNS).parquet(f"{self.path}/schemas/{version}/table")
            limits = config.max_broadcast_bytes, config.max_broadcast_schemas, config.max_copied_bytes
            held = self._keep("schemas", version, Registry.load(table, *limits))
        return held
