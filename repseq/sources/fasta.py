"""FASTA and cluster files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.functions.dna import header_id, is_valid, normalised
from repseq.operators.dedup import dedup_last_by_id


def _records(block: Column) -> Column:
    """``array<struct<read_id,description,seq>>`` of the text of a block of records, each from a ``>`` at the start of a line."""
    own = F.split(F.concat(F.lit("\n"), block), "\n>")
    record = lambda r: F.struct(header_id(F.substring_index(r, "\n", 1)).alias("read_id"), F.trim(F.substring_index(r, "\n", 1)).alias("description"), F.regexp_replace(F.regexp_replace(r, r"^[^\n]*", ""), r"\s+", "").alias("seq"))
    return F.transform(F.filter(F.slice(own, 2, 1 << 30), lambda r: F.length(F.trim(r)) > 0), record)


def read_fasta(spark: SparkSession, path: str, last_wins: bool = True, lead: bool = False, extra: dict[str, Column] | None = None) -> DataFrame:
    """``(read_id, seq, ord)``: a record a row, split where lines begin with ``>``; files are cut for many tasks.

    The id is the header's first token; lines are joined without white space. Of
    repeated ids the last in the file stays, unless ``last_wins`` is off. Text before the first header is not a record; with ``lead`` it is a row of the empty id. ``extra`` adds columns of the scan.
    """
    extra = extra or {}
    lines = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", bool(extra)).text(path).withColumn("ord", F.monotonically_increasing_id())
    text = F.regexp_replace("value", r"\r", "")
    first = F.startswith(text, F.lit(">"))
    rows = lines.select(F.when(first, F.substring(text, 2, 1 << 30)).otherwise(text).alias("r"), "ord", F.col("_metadata.file_block_start").alias("at"), first.alias("first"), *(c.alias(k) for k, c in extra.items()))
    before = F.expr("ord % 8589934592 = 0 AND at = 0 AND NOT first")
    rows = rows.where(~before | F.lit(lead) & F.col("r").rlike(r"\S")).withColumn("r", F.when(before, F.concat(F.lit("\n"), "r")).otherwise(F.col("r"))).where("trim(r) <> ''")
    out = rows.select(header_id(F.substring_index("r", "\n", 1)).alias("read_id"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*", ""), r"\s+", "").alias("seq"), "ord", *extra)
    return dedup_last_by_id(out).select("read_id", "seq", "ord") if last_wins else out


def read_fasta_strict(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """As ``read_fasta``, in upper case; text before the first header, an empty header or sequence or a letter outside the alphabet is an error."""
    rows = read_fasta(spark, path, last_wins=False, lead=True).withColumn("seq", normalised(F.col("seq")))
    bad = (F.col("read_id") == "") | (F.col("seq") == "") | ~is_valid(F.col("seq"), compat)
    message = F.concat(F.lit("not a sequence record: "), "read_id")
    return rows.withColumn("seq", F.when(bad, F.raise_error(message)).otherwise(F.col("seq")))


def validate_reads(reads: DataFrame, compat: bool = False) -> DataFrame:
    """``reads`` plus ``norm_seq`` and ``valid``, for those who would rather keep bad rows aside."""
    norm = normalised(F.col("seq"))
    return reads.withColumn("norm_seq", norm).withColumn("valid", F.coalesce(is_valid(norm, compat) & (F.col("read_id").cast("string") != ""), F.lit(False)))


def read_clusters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(cluster_id, read_id, seq, description)`` of a cluster file: lines ``=name`` head blocks of records. Text before the first is dropped; of blocks of one name the last stays."""
    blocks = spark.read.option("lineSep", "\n=").text(path).withColumn("ord", F.monotonically_increasing_id())
    text = F.regexp_replace("value", r"\r", "")
    named = blocks.select(text.alias("b"), "ord", F.col("_metadata.file_block_start").alias("at"))
    headed = named.where("NOT (ord % 8589934592 = 0 AND at = 0 AND NOT startswith(b, '='))")
    body = F.regexp_replace("b", r"^=?[^\n]*\n?", "")
    rows = headed.select(F.trim(F.regexp_replace(F.substring_index("b", "\n", 1), "^=", "")).alias("cluster_id"), body.alias("body"), "ord")
    last = dedup_last_by_id(rows, "cluster_id")
    return last.select("cluster_id", F.explode(_records(F.col("body"))).alias("r")).select("cluster_id", "r.read_id", "r.seq", "r.description")


# --- text out -----------------------------------------------------------------------


def render_fasta(name: Column, seq: Column, width: int | None = None) -> Column:
    """A record; the sequence in lines of ``width``, or in one."""
    body = seq if width is None else F.rtrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n"))
    return F.concat(F.lit(">"), name, F.lit("\n"), body)


def render_hits(name: Column, hits: Column) -> Column:
    """``>id (begin,end,score) ...``"""
    of = lambda h: F.concat(F.lit("("), h.begin.cast("string"), F.lit(","), h.end.cast("string"), F.lit(","), h.score.cast("string"), F.lit(")"))
    return F.concat_ws(" ", F.concat(F.lit(">"), name), F.array_join(F.transform(hits, of), " "))


def parse_hits(line: Column) -> Column:
    """Hits of such a line."""
    triples = F.regexp_extract_all(line, F.lit(r"\((\d+,\d+,-?\d+)\)"), F.lit(1))
    return F.transform(triples, lambda t: F.struct(*(F.split_part(t, F.lit(","), F.lit(k)).cast("int").alias(n) for k, n in enumerate(("begin", "end", "score"), 1))))


def render_clusters(members: DataFrame, cluster: str = "cluster_id", name: str = "uid", seq: str = "seq") -> DataFrame:
    """``(cluster_id, block)``: the ``=name`` line and the records of a cluster, in order of name."""
    records = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), render_fasta(F.col(name), F.col(seq)).alias("r"))))
    return members.groupBy(cluster).agg(F.concat(F.lit("="), F.first(cluster).cast("string"), F.lit("\n"), F.array_join(F.transform(records, lambda x: x.r), "\n")).alias("block"))


def write_text(rows: DataFrame, column: str, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """One text column as files, in folders by ``partition_by`` (sample, status)."""
    out = rows.select(*partition_by, F.col(column).alias("value")).write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).text(path)
