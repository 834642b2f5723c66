"""The schema table: which schema a message, a subject or a whole job uses."""

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.config import check_json
from sluicegate.session import work_dir

# Schemas up to this size are broadcast and read into the decoder: of the whole table, or else
# those of the ids in use.  Beyond that they are joined to the messages instead.
MAX_BROADCAST_BYTES = 16 << 20
MAX_BROADCAST_SCHEMAS = 20_000
# So many ids in use, of 8 bytes each, are sent to where the entries are.
MAX_BROADCAST_IDS = 1_000_000

# In that join the messages of one schema are spread over as many tasks as there are shuffle
# partitions, each with its own copy of the schema, as long as all copies stay within this.
# Adaptive execution splits a hot schema further; micro-batches may want fewer copies.
MAX_COPIED_BYTES = 8 << 30
COORDINATES = ("topic", "partition", "offset")

SCHEMA_COLUMNS = "subject string, version bigint, schema_id bigint, schema_json string"


def latest_schema(schemas, subject=None):
    """The newest version per subject (or of one): ``subject, version, schema_id, schema_json``."""
    if subject is not None:
        schemas = schemas.where(F.col("subject") == subject)
    newest = F.max_by(F.struct("version", "schema_id", "schema_json"), "version").alias("s")
    return schemas.groupBy("subject").agg(newest).select("subject", "s.*")


def read_schema_file(spark, path):
    """Text of one schema file, checked to be JSON."""
    found = spark.read.text(path, wholetext=True).head(2)
    if not found:
        raise ValueError(f"schema file is empty: {path}")
    if len(found) > 1:
        raise ValueError(f"several schema files: {path}")
    check_json(path, found[0].value)
    return found[0].value


def resolve_schema(spark, schemas, config):
    """Reader schema of a job as ``(source, text)``: inline, else file, else the newest one
    registered for the subject."""
    if config.reader_schema.strip():
        return "inline", config.reader_schema
    if config.reader_schema_file.strip():
        return "file", read_schema_file(spark, config.reader_schema_file)
    if isinstance(schemas, Registry):
        raise ValueError("the newest schema of a subject needs the schema table itself")
    newest = latest_schema(schemas, config.subject).head()
    if newest is None:
        raise ValueError(f"no schema registered for subject {config.subject!r}")
    return "registry", newest.schema_json


@dataclass(frozen=True)
class Registry:
    """A schema table prepared for decoding: one row per id, and its size checked.

    ``texts`` maps id to schema if the table may be broadcast, else it is ``None`` and
    ``copies`` says how often each schema goes into the join."""

    table: DataFrame  # schema_id, schema_json
    texts: dict | None
    copies: int = 1
    max_bytes: int = MAX_BROADCAST_BYTES
    max_schemas: int = MAX_BROADCAST_SCHEMAS
    entries: DataFrame | None = None  # of a large table: what ``table`` is made of
    hot: tuple | None = None  # ids that go into the join in copies; None: all

    @classmethod
    def load(
        cls,
        schemas,
        max_bytes=MAX_BROADCAST_BYTES,
        max_schemas=MAX_BROADCAST_SCHEMAS,
        max_copied_bytes=MAX_COPIED_BYTES,
    ):
        if isinstance(schemas, cls):
            return schemas
        table = newest_entries(schemas)
        sizes = schemas.groupBy("schema_id").agg(F.sum(F.octet_length("schema_json")).alias("bytes"))
        sizes = sizes.agg(F.count("*").alias("ids"), F.sum("bytes").alias("bytes"))
        [size] = sizes.collect()  # no text is moved for these
        texts, most = None, size.bytes or 0  # with older entries of an id, if it has some
        if size.ids <= max_schemas:
            texts, kept = texts_within(table, max_bytes, max_schemas)
            most = kept or 0
        if texts is not None:
            return cls(table, texts)
        partitions = int(schemas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        copies = max(1, min(partitions, max_copied_bytes // (most or 1)))
        return cls(table, None, copies, max_bytes, max_schemas, schemas)

    def in_use(self, messages):
        """The registry with the schemas of these split messages only, if they may be broadcast.

        The ids are counted where the messages are, so a few bytes per id travel.  Entries of other ids are
        left out before their texts are moved or compared.  If those in use are too many as well, only
        the schemas with many messages go into the join in copies.  A plain stream does not know the
        ids to come and keeps the whole registry, and all copies."""
        if self.texts is not None or messages.isStreaming:
            return self
        ids = messages.where(F.col("schema_id").isNotNull()).groupBy("schema_id")
        ids = ids.agg(F.count("*").alias("uses")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            [all_] = ids.agg(F.count("*").alias("n"), F.sum("uses").alias("uses")).collect()
            few = F.broadcast(ids) if all_.n <= MAX_BROADCAST_IDS else ids
            entries = self.table if self.entries is None else self.entries
            known = entries.select("schema_id").join(few, "schema_id", "left_semi").distinct()
            table = entries.join(few, "schema_id", "left_semi")
            table = table if self.entries is None else newest_entries(table)
            texts = None
            if known.count() <= self.max_schemas:
                texts, _ = texts_within(table, self.max_bytes, self.max_schemas)
            if texts is not None:
                return replace(self, table=table, texts=texts)
            # a share of a task's messages, so there are at most 4 of them for each copy
            often = F.col("uses") > (all_.uses or 0) / (4 * self.copies)
            hot = tuple(sorted(r.schema_id for r in ids.where(often).collect()))
            table = settled(table)  # while the ids are kept
        finally:
            ids.unpersist()
        return replace(self, table=table, hot=hot)


def settled(table):
    """The rows, written once to the cluster's shared folder: each use of those in use would read the
    messages again for their ids.  A cluster without such a folder does just that."""
    try:
        path = work_dir(table.sparkSession, "schemas")
    except ValueError:
        return table
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def newest_entries(schemas):
    """schema_id, schema_json.  An id can be listed under several subjects or versions; the newest entry counts."""
    newest = F.max_by("schema_json", F.struct("version", "subject", "schema_json"))
    return schemas.groupBy("schema_id").agg(F.coalesce(newest, F.lit("")).alias("schema_json"))


def texts_within(table, max_bytes, max_schemas):
    """``({id: schema}, bytes)`` of a table with a row per id, ``(None, bytes)`` if it is larger.

    The rows are kept from the check to the reading, so no more than was checked is read."""
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        [size] = table.agg(
            F.count("*").alias("n"), F.sum(F.octet_length("schema_json")).alias("bytes")
        ).collect()
        if size.n > max_schemas or (size.bytes or 0) > max_bytes:
            return None, size.bytes
        return {r.schema_id: r.schema_json for r in table.collect()}, size.bytes
    finally:
        table.unpersist()


def copied(registry):
    """Whether messages of an id are spread over copies of its schema; un-framed ones always are."""
    if registry.hot is None:
        return F.lit(True)
    return F.col("schema_id").isNull() | F.col("schema_id").isin(*registry.hot)


def salted(messages, registry):
    """The messages with a ``salt`` that spreads those of one schema over the registry's copies, by
    the coordinates they have, or by value."""
    there = [c for c in COORDINATES if c in messages.columns]
    spread = there if "offset" in there else [*there, "value"]
    salt = F.pmod(F.xxhash64(*spread), F.lit(registry.copies)).cast("int")
    return messages.withColumn("salt", F.when(copied(registry), salt).otherwise(0))


def schema_copies(registry):
    """schema_id, schema_json, salt: every schema once, or as often as the registry says."""
    salts = F.sequence(F.lit(0), F.when(copied(registry), registry.copies - 1).otherwise(0))
    return registry.table.select("schema_id", "schema_json", F.explode(salts).alias("salt"))


def sorted_in(messages, registry):
    """Messages and schemas together, those of one schema and salt in a row, the schema first.

    A task that reads the rows in order needs the schema text once, not with each message.  Rows of
    schemas have a ``schema_json``; the messages' columns are null there."""
    both = salted(messages, registry).withColumn("schema_json", F.lit(None).cast("string"))
    both = both.unionByName(schema_copies(registry), allowMissingColumns=True)
    order = ["schema_id", "salt", F.col("schema_json").isNull()]
    return both.repartition("schema_id", "salt").sortWithinPartitions(*order).drop("salt")


def attach_schema(messages, registry):
    """Add ``known`` (null for un-framed messages) and, from a large table, ``schema_json``.

    A checked small table is a broadcast join on its ids.  A large one is a salted join: the
    messages of one schema are spread over many tasks by the coordinates they have, or by value."""
    if registry.texts is not None:
        ids = pa.table({"schema_id": pa.array(registry.texts, pa.int64())})
        ids = messages.sparkSession.createDataFrame(ids).withColumn("known", F.lit(True))
        joined = messages.join(F.broadcast(ids), "schema_id", "left")
    else:
        copies = schema_copies(registry).withColumn("known", F.lit(True))
        joined = (
            salted(messages, registry)
            .join(copies.hint("shuffle_merge"), ["schema_id", "salt"], "left")
            .drop("salt")
        )
    known = F.when(F.col("schema_id").isNotNull(), F.coalesce("known", F.lit(False)))
    return joined.withColumn("known", known)
