"""Deterministic DNA reads from ``orders``, as SQL that Spark and DuckDB evaluate alike.

Sample, clone, V region and loop are functions of the customer; errors, strand and what
becomes of the adapters are functions of the order. The result carries what was planted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Clones, as SQL: 60 for each 6,000 orders begun, so that distinct sequences grow with the table. A multiple of 60, as sample, V region and length of the loop go by the customer.
CLONES = "(60 * (1 + CAST(floor((SELECT count(*) FROM orders) / 6000.0) AS BIGINT)))"

#: Adapters of the three samples: barcode and primer of either side.
ADAPTERS = [
    ("ACGAGTGCGT", "GGTCACCATCTCGAAGGACAGC", "CTAGCTGACA", "CAGTGGACTTCCAGTACCTGATGCA"),
    ("TGATACGTCT", "GGTCACCATCTCGAAGGACAGC", "GATCAGTCAG", "CAGTGGACTTCCAGTACCTGATGCA"),
    ("CATAGTAGTG", "TTCCGGATGACTACGTTGCATG", "ATGCACTGTC", "GACCTTGAGGATCACTGGTCATTAC"),
]
SAMPLES = ["s0", "s1", "s2"]


def config_rows() -> list[tuple]:
    return [(SAMPLES[k], fm, rm, fp, rp, ["YYC"], ["WG[QKR]"], 2, 2, k) for k, (fm, fp, rm, rp) in enumerate(ADAPTERS)]


def config(spark: SparkSession) -> DataFrame:
    from repseq.sources.config import CONFIG

    return spark.createDataFrame(config_rows(), CONFIG + ", cfg_ord int")


def _text(x: str) -> str:
    return f"cast({x} as varchar(20))"


def _dna(x: str) -> str:
    """32 bases of a key."""
    return f"translate(md5({x}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _rc(x: str) -> str:
    return f"reverse(translate({x}, 'ACGTacgt', 'TGCAtgca'))"


def _adapter(side: int) -> str:
    whole = [a[2 * side] + a[2 * side + 1] for a in ADAPTERS]
    return f"CASE s WHEN 0 THEN '{whole[0]}' WHEN 1 THEN '{whole[1]}' ELSE '{whole[2]}' END"


def reads_sql(clones: str | int = CLONES) -> str:
    """The rows of ``reads``: read_id, ord, seq, sample, clone, status, core (with its error), true_core."""
    v = " || ".join(_dna(f"'v' || {_text('u % 12')} || '_{i}'") for i in range(5))
    loop = f"substring({_dna(f"'ca' || {_text('clone')}")} || {_dna(f"'cb' || {_text('clone')}")}, 1, cast(36 + 3 * (u % 5) as int))"
    return f"""
    SELECT k AS read_id, k AS ord, 'acg' || CASE WHEN k % 2 = 1 THEN {_rc('whole')} ELSE whole END || 'nt' AS seq,
      CASE WHEN status IN ('ok', 'incomplete') THEN 's' || {_text('s')} END AS sample, clone, status, core, true_core
    FROM (
      SELECT *, CASE status WHEN 'nomid' THEN core WHEN 'incomplete' THEN f || core WHEN 'has_n' THEN f || 'N' || core || {_rc('r')} ELSE f || core || {_rc('r')} END AS whole
      FROM (
        SELECT *, CASE WHEN k % 7 = 0 THEN substring(true_core, 1, 176) || 'A' || substring(true_core, 178) WHEN k % 11 = 0 THEN substring(true_core, 1, 41) || substring(true_core, 43) ELSE true_core END AS core,
          CASE WHEN k % 13 = 0 THEN 'nomid' WHEN k % 34 = 0 THEN 'incomplete' WHEN k % 19 = 0 THEN 'has_n' ELSE 'ok' END AS status,
          {_adapter(0)} AS f, {_adapter(1)} AS r
        FROM (
          SELECT k, u, clone, u % 3 AS s, {v} || 'TATTATTGT' || {loop} || 'TGGGGCAAG' || {_dna("'tail'")} AS true_core
          FROM (SELECT o_orderkey AS k, o_custkey AS u, o_custkey % {clones} AS clone FROM orders) a
        ) b
      ) c
    ) d"""


READS = reads_sql()
#: Clipped reads as they should come out: sample, seq; and the distinct ones with their number.
OK = f"SELECT read_id, ord, sample, clone, core AS seq, true_core FROM ({READS}) o WHERE status = 'ok'"
UNIQUE = f"SELECT sample, seq, count(*) AS qty, min(clone) AS clone, min(true_core) AS true_core FROM ({OK}) q GROUP BY sample, seq"


def _rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of ``sql``. Orders are dealt out by key first: a few bytes each make hundreds, so the splits of their files would be too few tasks."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    dealt = orders.select("o_orderkey", "o_custkey").repartition(4 * spark.sparkContext.defaultParallelism, "o_orderkey")
    counted = sql.replace("count(*) FROM orders", "count(*) FROM {counted}")
    return spark.sql(counted.replace("FROM orders", "FROM {orders}"), orders=dealt, counted=orders)


def reads(spark: SparkSession, sf_dir: str, clones: str | int = CLONES) -> DataFrame:
    return _rows(spark, sf_dir, reads_sql(clones))


def ok_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, OK)


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out again: these are few bytes, which adaptive execution would put into a few tasks, but motif scans and alignments follow."""
    return _rows(spark, sf_dir, UNIQUE).repartition(4 * spark.sparkContext.defaultParallelism, "sample", "seq")
