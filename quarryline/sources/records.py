"""Record and evidence documents: JSON on read, flattened to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from quarryline.functions.text import name_key
from quarryline.sources.tableset import TableSet

_S = StringType()


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


ENTRY = _struct(
    name=_S, type=_S, description=_S, scale_note=_S, category=_S, wiki_page=_S, topic=_S, subroom=_S, magnitude=_S, catalogued=BooleanType(), excluded=_S, stale_since=_S
)
RECORD = _struct(
    source=_S, mode=_S, status=_S, attestation=_S, provenance=_S,
    synthesis=_struct(ceiling_entity=_S, provisional_magnitude=_S, evidence=_S, rationale=_S),
    entries=ArrayType(ENTRY), _corrupt=_S,
)
EVIDENCE = _struct(
    entity=_S, host=_S, pages_read=ArrayType(_S), chars_read=LongType(), feats=ArrayType(_struct(feat=_S, page=_S)),
    gate_rejected=ArrayType(_struct(text=_S, page=_S)), _corrupt=_S,
)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One document a file; a file that does not parse has its text in ``_corrupt``. Adds ``file``."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.withColumn("file", F.col("_metadata.file_name"))


def unreadable(documents: DataFrame) -> DataFrame:
    """Files that do not parse. A second column is read because Spark refuses queries on the corrupt text alone."""
    other = F.coalesce(F.col(documents.columns[0]).cast("string"), F.col("_corrupt"))
    return documents.where(F.col("_corrupt").isNotNull() & other.isNotNull()).select("file")


def entries(records: DataFrame) -> DataFrame:
    """One row an entry of the readable records; nulls in the array are left out."""
    rows = records.where(F.col("_corrupt").isNull()).select("source", "file", F.posexplode("entries").alias("pos", "entry"))
    return rows.where(F.col("entry").isNotNull()).select("source", "file", "pos", "entry.*", F.coalesce(F.length("entry.description"), F.lit(0)).alias("description_chars"))


def sources(records: DataFrame) -> DataFrame:
    """source, entries, files; a source that two files claim is one row."""
    return records.where(F.col("_corrupt").isNull()).groupBy("source").agg(F.sum(F.coalesce(F.size("entries"), F.lit(0))).alias("entries"), F.count_distinct("file").alias("files"))


def evidence(documents: DataFrame) -> DataFrame:
    """entity, host, feats, pages, chars, refused of each evidence document."""
    n = lambda c: F.greatest(F.size(c), F.lit(0))
    return documents.where(F.col("_corrupt").isNull()).select("entity", "host", n("feats").alias("feats"), n("pages_read").alias("pages"), F.coalesce("chars_read", F.lit(0)).alias("chars"), n("gate_rejected").alias("refused"))


def index_collisions(rows: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(the last row of each key by ``order``, key and n of each key that several rows claim)."""
    columns = rows.columns
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*columns), F.struct(F.col(order), *columns)).alias("r")).select("r.*")
    return last, rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rebuild(spark: SparkSession, records_path: str, evidence_paths: list[str], folder: str) -> dict[str, int]:
    """Scans all records and evidence trees and puts the four tables in place in one commit: source, entry, evidence, meta.

    Never incremental: what is no longer in the files is no longer in the tables. Of an entity that two
    trees have, the row of the later tree counts. Readers (``TableSet(spark, folder).read``) see the tables of one rebuild,
    never some of the last one. Returns rows by table; ``meta`` says which files did not parse.
    """
    docs = read_json(spark, records_path, RECORD)
    found = spark.createDataFrame([], "entity string, host string, feats int, pages int, chars long, refused int, _tree int")
    for k, path in enumerate(evidence_paths):
        found = found.unionByName(evidence(read_json(spark, path, EVIDENCE)).withColumn("_tree", F.lit(k)))
    kept = found.groupBy("entity", "host").agg(F.max_by(F.struct("feats", "pages", "chars", "refused"), "_tree").alias("r")).select("entity", "host", "r.*")
    bad = unreadable(docs).select(F.lit("unreadable").alias("key"), F.col("file").alias("value"))
    tables = TableSet(spark, folder)
    done = tables.commit({"source": sources(docs), "entry": entries(docs), "evidence": kept, "meta": bad})
    return {name: tables.read(name, done).count() for name in done.paths}


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """Elements of XML files as rows, by Spark's own XML source."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def distinct_elements(elements: DataFrame, kind: str, name: str, description: str, order: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped, unparsed) elements of a catalogue.

    Only exact restatements drop: one type, one folded name and one description; the first by ``order``
    stays. Elements without a type or a name are unparsed.
    """
    named = (F.trim(F.coalesce(F.col(name), F.lit(""))) != "") & (F.trim(F.coalesce(F.col(kind), F.lit(""))) != "")
    rows = elements.where(named)
    key = F.sha2(F.concat_ws(chr(31), F.col(kind), name_key(name), F.coalesce(F.col(description), F.lit(""))), 256)
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return numbered.where("_n = 1").drop("_n"), numbered.where("_n > 1").drop("_n"), elements.where(~named)
