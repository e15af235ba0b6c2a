"""Every query on the driver's tables, with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.functions import align, dna
from repseq.functions import motif as M
from repseq.operators import cdr3, cluster, consensus, correct, dedup, demux, simjoin
from repseq.operators.components import connected_components as components_of
from repseq.operators.numbering import numbered
from repseq.operators.shared import checkpoint_dir, materialise
from repseq.plans import pipeline, synth
from repseq.sources import fasta, fastq, routed
from repseq.sources.config import read_config

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_READS = f"WITH reads AS ({synth.READS}), ok AS ({synth.OK}), uniq AS MATERIALIZED ({synth.UNIQUE})\n"


def query(sql: str | None = None, reads: bool = True):
    """Registers a query under its function's name."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (_READS if reads and not sql.lstrip().startswith("WITH ") else "") + sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scalar functions ---------------------------------------------------------------


@query("SELECT read_id, reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan')) AS rc FROM reads")
def reverse_complement(spark, sf_dir):
    return synth.reads(spark, sf_dir).select("read_id", dna.reverse_complement(F.col("seq")).alias("rc"))


@query("SELECT read_id, trim(seq, 'acgtn') AS trimmed FROM reads")
def trim_soft_ends(spark, sf_dir):
    return synth.reads(spark, sf_dir).select("read_id", dna.trim_soft_ends(F.col("seq")).alias("trimmed"))


@query("SELECT read_id FROM reads WHERE contains(trim(seq, 'acgtn'), 'N')")
def filter_ambiguous(spark, sf_dir):
    return synth.reads(spark, sf_dir).where(dna.is_ambiguous(dna.trim_soft_ends(F.col("seq")))).select("read_id")


@query(f"SELECT p_partkey AS read_id, upper(regexp_replace(p_name, '\\s+', '', 'g')) AS norm_seq, regexp_full_match(upper(regexp_replace(p_name, '\\s+', '', 'g')), '[{dna.ALPHABET}]+') AS valid FROM part UNION ALL SELECT read_id, upper(seq), true FROM ({synth.READS}) r", reads=False)
def validate_reads(spark, sf_dir):
    both = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("read_id"), F.col("p_name").alias("seq")).unionByName(synth.reads(spark, sf_dir).select("read_id", "seq"))
    return fasta.validate_reads(both).select("read_id", "norm_seq", "valid")


@query("SELECT read_id, list_transform(range(1, length(seq) - 20 + 1), lambda i: substring(seq, CAST(i AS INT), 21)) AS kmers FROM ok")
def kmers(spark, sf_dir):
    return synth.ok_reads(spark, sf_dir).select("read_id", dna.kmers(F.col("seq"), 21).alias("kmers"))


_CODON_ROWS = "SELECT substring(seq, CAST(3 * i + 1 AS INT), 3) AS codon FROM (SELECT seq, unnest(range(0, length(seq) // 3)) AS i FROM uniq) x"


def _base(k: int) -> str:
    return f"(strpos('TCAG', substring(seq, CAST(i * 3 + {k} AS INT), 1)) - 1)"


#: The standard code in the order TCAG of its three bases, as published; the reads have no other letters.
_CODE = f"substring('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(16 * {_base(1)} + 4 * {_base(2)} + {_base(3)} + 1 AS INT), 1)"


@query(f"SELECT codon, {_CODE.replace('seq', 'codon').replace('i * 3', '0')} AS aa, count(*) AS n FROM ({_CODON_ROWS}) c GROUP BY codon")
def codon_table(spark, sf_dir):
    """The codons of all unique reads, what each stands for, and how often it occurs."""
    codons = F.transform(F.sequence(F.lit(0), F.floor(F.length("seq") / 3).cast("int") - 1), lambda i: F.substring(F.col("seq"), i * 3 + 1, F.lit(3)))
    rows = synth.unique(spark, sf_dir).where("length(seq) >= 3").select(F.explode(codons).alias("codon"))
    return rows.groupBy("codon").agg(F.count("*").alias("n")).select("codon", dna.translate_protein(F.col("codon")).alias("aa"), "n")


@query(f"SELECT sample, seq, array_to_string(list_transform(range(0, length(seq) // 3), lambda i: {_CODE}), '') AS protein FROM uniq")
def translate_protein(spark, sf_dir):
    return synth.unique(spark, sf_dir).select("sample", "seq", dna.translate_protein(F.col("seq")).alias("protein"))


@query("SELECT read_id, replace(g, '-', '') AS ungapped, rtrim(g, '-') AS cut FROM (SELECT read_id, replace(replace(seq, 'AA', '--'), 'nt', '--') AS g FROM reads) x")
def strip_gaps(spark, sf_dir):
    g = F.replace(F.replace("seq", F.lit("AA"), F.lit("--")), F.lit("nt"), F.lit("--"))
    rows = synth.reads(spark, sf_dir).select("read_id", g.alias("g"))
    return rows.select("read_id", dna.strip_gaps(F.col("g")).alias("ungapped"), dna.strip_gaps(F.col("g"), True).alias("cut"))


@query("SELECT read_id, CAST(instr(seq, substring(core, 1, 20)) - 1 AS BIGINT) AS place FROM reads")
def locate(spark, sf_dir):
    return synth.reads(spark, sf_dir).select("read_id", dna.locate(F.col("seq"), F.substring("core", 1, 20)).cast("long").alias("place"))


@query("SELECT sample, seq, CAST(split_part('Seq1_' || CAST(qty AS VARCHAR), '_', 2) AS BIGINT) AS mult FROM uniq")
def parse_multiplicity(spark, sf_dir):
    return synth.unique(spark, sf_dir).select("sample", "seq", dna.multiplicity(F.concat(F.lit("Seq1_"), F.col("qty").cast("string"))).alias("mult"))


@query("SELECT sample, seq, qty FROM uniq WHERE qty >= 3")
def abundance_filter(spark, sf_dir):
    return synth.unique(spark, sf_dir).where("qty >= 3").select("sample", "seq", "qty")


# --- text in and out ----------------------------------------------------------------


@query("SELECT read_id, '>' || CAST(read_id AS VARCHAR) || chr(10) || seq AS record FROM reads")
def render_fasta(spark, sf_dir):
    return synth.reads(spark, sf_dir).select("read_id", fasta.render_fasta(F.col("read_id").cast("string"), F.col("seq")).alias("record"))


@query("SELECT read_id, '>' || CAST(read_id AS VARCHAR) || chr(10) || rtrim(regexp_replace(seq, '(.{80})', '\\1' || chr(10), 'g'), chr(10)) AS record FROM reads")
def render_fasta80(spark, sf_dir):
    return synth.reads(spark, sf_dir).select("read_id", fasta.render_fasta(F.col("read_id").cast("string"), F.col("seq"), 80).alias("record"))


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


@query("SELECT CAST(read_id AS VARCHAR) AS read_id, seq FROM reads")
def scan_fasta(spark, sf_dir):
    path = _scratch(spark)
    fasta.write_text(render_fasta80(spark, sf_dir), "record", path)
    return fasta.read_fasta(spark, path).select("read_id", "seq")


@query("SELECT CAST(read_id AS VARCHAR) AS read_id, seq, repeat('@', length(seq)) AS qual FROM reads")
def scan_fastq(spark, sf_dir):
    path = _scratch(spark)
    record = F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit(" x\n"), "seq", F.lit("\n+\n"), F.expr("repeat('@', length(seq))"))
    fasta.write_text(synth.reads(spark, sf_dir).withColumn("record", record), "record", path)
    return fastq.read_fastq(spark, path, keep_quality=True).select("read_id", "seq", "qual")


@query("SELECT CAST(read_id AS VARCHAR) AS read_id, seq, CASE WHEN read_id % 2 = 0 THEN '@' ELSE '+' END || repeat('@', length(seq) - 1) AS qual, CAST(row_number() OVER (ORDER BY read_id) AS BIGINT) AS nth FROM reads")
def scan_fastq_split(spark, sf_dir):
    """A file in pieces of 4,000 bytes that begin anywhere, with qualities that look like headers."""
    path = _scratch(spark)
    qual = F.concat(F.when(F.col("read_id") % 2 == 0, F.lit("@")).otherwise(F.lit("+")), F.expr("repeat('@', length(seq) - 1)"))
    record = F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit(" x\n"), "seq", F.lit("\n+\n"), qual)
    fasta.write_text(synth.reads(spark, sf_dir).repartitionByRange(2, "read_id").sortWithinPartitions("read_id").withColumn("record", record), "record", path)
    rows = fastq.read_fastq(spark, path, keep_quality=True, last_wins=False, split_bytes=4000)
    return numbered(rows, [], ["ord"], "__n").select("read_id", "seq", "qual", (F.col("__n") + 1).alias("nth"))


@query("SELECT CASE status WHEN 'ok' THEN sample || '/' || sample || '.fasta' WHEN 'incomplete' THEN sample || '/' || sample || '_incomplete.fasta' ELSE 'filtered.fasta' END AS file, CAST(read_id AS VARCHAR) AS read_id, CASE status WHEN 'ok' THEN core WHEN 'incomplete' THEN trim(seq, 'acgtn') ELSE seq END AS seq FROM reads")
def route_reads(spark, sf_dir):
    """Demultiplexed reads written to the files of a run, and read again with the file each came from."""
    path = _scratch(spark)
    routed.write_demultiplexed(_demuxed(spark, sf_dir), path)
    return routed.read_routed(spark, path)


_NAMED = "(SELECT *, 'Cluster_' || CAST(dense_rank() OVER (PARTITION BY sample ORDER BY clone) AS VARCHAR) || '_' || CAST(count(*) OVER (PARTITION BY sample, clone) AS VARCHAR) AS cluster_name FROM found)"


@query("SELECT sample, cluster_name, seq FROM (SELECT *, 'Cluster_' || CAST(dense_rank() OVER (PARTITION BY sample ORDER BY clone) AS VARCHAR) || '_' || CAST(count(*) OVER (PARTITION BY sample, clone) AS VARCHAR) AS cluster_name FROM uniq) x")
def cluster_names(spark, sf_dir):
    return dedup.cluster_names(synth.unique(spark, sf_dir), cluster="clone").select("sample", "cluster_name", "seq")


_CLUSTERS = "SELECT sample || '_' || CAST(clone AS VARCHAR) AS cluster_id, md5(seq) AS uid, seq FROM uniq"


def _clusters(spark, sf_dir):
    cid = F.concat_ws("_", "sample", F.col("clone").cast("string"))
    return synth.unique(spark, sf_dir).select(cid.alias("cluster_id"), F.md5("seq").alias("uid"), "seq")


@query(f"SELECT cluster_id, '=' || cluster_id || chr(10) || string_agg('>' || uid || chr(10) || seq, chr(10) ORDER BY uid) AS block FROM ({_CLUSTERS}) c GROUP BY cluster_id")
def render_clusters(spark, sf_dir):
    return fasta.render_clusters(_clusters(spark, sf_dir))


@query(f"SELECT cluster_id, uid AS read_id, seq FROM ({_CLUSTERS}) c")
def scan_clusters(spark, sf_dir):
    path = _scratch(spark)
    fasta.write_text(render_clusters(spark, sf_dir), "block", path)
    return fasta.read_clusters(spark, path).select("cluster_id", "read_id", "seq")


_MID = "substring(translate(md5({0} || s_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, {1})"
_SAMPLES = f"""SELECT s_name AS sampleName, {_MID.format("'a'", 10)} AS forwardMid, {_MID.format("'b'", 10)} AS reverseMid, {_MID.format("'c'", 22)} AS forwardPrimer, {_MID.format("'d'", 25)} AS reversePrimer,
  ARRAY{{0}}'YYC'{{1}} AS cdr3Start, ARRAY{{0}}'WG[QKR]'{{1}} AS cdr3End, CAST(s_nationkey % 3 + 1 AS INT) AS cdr3Threshold, CAST(s_nationkey % 5 AS INT) AS sequenceThreshold, CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INT) AS cfg_ord FROM"""


@query(f"{_SAMPLES.format('[', ']')} supplier", reads=False)
def scan_config(spark, sf_dir):
    """A configuration of a sample a supplier, written as one JSON array and read again."""
    path = _scratch(spark)
    rows = spark.sql(_SAMPLES.format("(", ")") + " {supplier}", supplier=_table(spark, sf_dir, "supplier"))
    one = rows.agg(F.array_sort(F.collect_list(F.struct("cfg_ord", F.struct(*(c for c in rows.columns if c != "cfg_ord")).alias("c")))).alias("all"))
    fasta.write_text(one.select(F.to_json(F.transform("all", lambda x: x.c)).alias("j")), "j", path)
    return read_config(spark, path)


# --- motifs and CDR3 ----------------------------------------------------------------


def _scan_sql(of: str, column: str, motif: str) -> str:
    """Hits by place as rows (key, begin, stop, score) of a relation with ``key`` and ``column``."""
    size = 3 * len(M.parse(motif))
    exact = f"regexp_full_match(substring({column}, CAST(i + 1 AS INT), {size}), '{M.exact_pattern(motif)}')"
    after = f"regexp_full_match(substring({column}, CAST(i + 2 AS INT), {size}), '{M.exact_pattern(motif)}')"
    longer = f"regexp_full_match(substring({column}, CAST(i + 1 AS INT), {size + 1}), '{M.insertion_pattern(motif)}')"
    return f"""SELECT sample, seq, i AS begin, CASE WHEN x THEN i + {size - 1} ELSE i + {size} END AS stop, CASE WHEN x THEN {size * M.MATCH} ELSE {size * M.MATCH + M.INDEL} END AS score
      FROM (SELECT sample, seq, i, {exact} AS x, {longer} AND NOT {after} AS y FROM (SELECT sample, seq, unnest(range(0, greatest(length({column}) - {size} + 1, 0))) AS i FROM {of}) p) q WHERE x OR y"""


_STARTS, _ENDS = _scan_sql("uniq", "seq", "YYC"), _scan_sql("uniq", "seq", "WG[QKR]")
_HITS = f"starts AS MATERIALIZED ({_STARTS}), ends AS MATERIALIZED ({_ENDS})"
_CANDIDATES = """SELECT s.sample, s.seq, s.begin, e.begin AS stop, s.score + e.score AS score FROM starts s JOIN ends e ON s.sample = e.sample AND s.seq = e.seq
  WHERE e.begin - s.begin BETWEEN 30 AND 90 AND s.begin > length(s.seq) // 2"""
_FOUND = f"""{_HITS}, cands AS ({_CANDIDATES}), found AS MATERIALIZED (
  SELECT u.sample, u.seq, u.qty, u.clone, c.begin, c.score, substring(u.seq, CAST(c.begin + 1 AS INT), CAST(c.stop - c.begin AS INT)) AS cdr
  FROM uniq u JOIN (SELECT *, row_number() OVER (PARTITION BY sample, seq ORDER BY score DESC, begin, stop) AS n FROM cands) c ON u.sample = c.sample AND u.seq = c.seq AND c.n = 1)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH reads AS ({synth.READS}), ok AS ({synth.OK}), uniq AS MATERIALIZED ({synth.UNIQUE}), {ctes}\n{select}"


def _exploded(spark, sf_dir, hits: str):
    return synth.unique(spark, sf_dir).select("sample", "seq", F.explode(hits).alias("h"))


@query(_with(_HITS, "SELECT sample, seq, CAST(begin AS INT) AS begin, CAST(stop AS INT) AS stop, score FROM starts"))
def motif_scan(spark, sf_dir):
    rows = synth.unique(spark, sf_dir).select("sample", "seq", F.explode(M.scan(F.col("seq"), "YYC")).alias("h"))
    return rows.select("sample", "seq", "h.begin", F.col("h.end").alias("stop"), "h.score")


@query(_with(_HITS, "SELECT sample, seq, CAST(begin AS INT) AS begin, CAST(stop AS INT) AS stop, score FROM ends"))
def motif_scan_general(spark, sf_dir):
    rows = synth.unique(spark, sf_dir).select("sample", "seq", F.explode(M.scan_general(F.col("seq"), "WG[QKR]")).alias("h"))
    return rows.select("sample", "seq", "h.begin", F.col("h.end").alias("stop"), "h.score")


@query(_with(_HITS, "SELECT sample, seq, 0 AS motif, CAST(begin AS INT) AS begin, score FROM starts UNION ALL SELECT sample, seq, 1, CAST(begin AS INT), score FROM ends"))
def motif_union(spark, sf_dir):
    rows = synth.unique(spark, sf_dir).select("sample", "seq", F.explode(cdr3.motif_hits(F.col("seq"), ["YYC", "WG[QKR]"])).alias("h"))
    return rows.select("sample", "seq", "h.motif", "h.begin", "h.score")


@query(_with(_HITS, "SELECT sample, seq, '>' || md5(seq) || CASE WHEN h IS NULL THEN ' ' ELSE ' ' || h END AS line FROM (SELECT u.sample, u.seq, string_agg('(' || CAST(begin AS VARCHAR) || ',' || CAST(stop AS VARCHAR) || ',' || CAST(score AS VARCHAR) || ')', ' ' ORDER BY begin) AS h FROM uniq u LEFT JOIN starts s ON s.sample = u.sample AND s.seq = u.seq GROUP BY u.sample, u.seq) x"))
def render_hits(spark, sf_dir):
    return synth.unique(spark, sf_dir).select("sample", "seq", fasta.render_hits(F.md5("seq"), M.scan(F.col("seq"), "YYC")).alias("line"))


@query(_with(_HITS, "SELECT sample, seq, CAST(begin AS INT) AS begin, CAST(stop AS INT) AS stop, score FROM starts"))
def parse_hits(spark, sf_dir):
    rows = render_hits(spark, sf_dir).select("sample", "seq", F.explode(fasta.parse_hits(F.col("line"))).alias("h"))
    return rows.select("sample", "seq", "h.begin", F.col("h.end").alias("stop"), "h.score")


@query("SELECT user_id AS read_id, ord, begin, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY score DESC, ord) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ord) AS island FROM (SELECT *, CASE WHEN begin IS DISTINCT FROM lag(begin) OVER (PARTITION BY user_id ORDER BY ord) THEN 1 ELSE 0 END AS new FROM (SELECT user_id, event_id AS ord, event_type AS begin, value AS score FROM events) e) a) b) c WHERE n = 1", reads=False)
def hit_islands(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(F.col("user_id").alias("read_id"), F.col("event_id").alias("ord"), F.col("event_type").alias("begin"), F.col("value").alias("score"))
    return cdr3.hit_islands(events)


@query(_with(f"{_HITS}, cands AS ({_CANDIDATES})", "SELECT sample, seq, CAST(begin AS INT) AS begin, CAST(stop AS INT) AS stop, score FROM cands"))
def cdr3_candidates(spark, sf_dir):
    s = F.col("seq")
    pairs = cdr3.candidates(s, cdr3.motif_hits(s, cdr3.STARTS), cdr3.motif_hits(s, cdr3.ENDS))
    rows = synth.unique(spark, sf_dir).select("sample", "seq", F.explode(pairs).alias("c"))
    return rows.select("sample", "seq", "c.begin", "c.stop", "c.score")


def _found(spark, sf_dir):
    return cdr3.with_cdr3(synth.unique(spark, sf_dir).select("sample", "seq", "qty", "clone"))


@query(_with(_FOUND, "SELECT sample, seq, cdr, CAST(begin AS INT) AS cdr_begin, CAST(score AS INT) AS cdr_score FROM found"))
def cdr3_extract(spark, sf_dir):
    return _found(spark, sf_dir).where("cdr IS NOT NULL").select("sample", "seq", "cdr", "cdr_begin", "cdr_score")


@query("SELECT sample, seq FROM (SELECT sample, substring(seq, 1, 150) AS seq FROM uniq WHERE clone % 2 = 0 UNION ALL SELECT sample, seq FROM uniq) x WHERE length(seq) <= 150")
def cdr3_missing(spark, sf_dir):
    both = synth.unique(spark, sf_dir)
    cut = both.where("clone % 2 = 0").select("sample", F.substring("seq", 1, 150).alias("seq")).unionByName(both.select("sample", "seq"))
    return cdr3.with_cdr3(cut).where("cdr IS NULL").select("sample", "seq")


@query(_with(_FOUND, f"SELECT sample || '/' || sample || '.cl' AS file, cluster_name AS cluster_id, md5(seq) AS read_id, cdr, seq FROM {_NAMED} x"))
def cluster_files(spark, sf_dir):
    """Cluster files with each member's CDR in its header and its full read, written and read again."""
    path = _scratch(spark)
    members = dedup.cluster_names(_found(spark, sf_dir).where("cdr IS NOT NULL"), cluster="clone")
    routed.write_clusters(members.withColumn("uid", F.md5("seq")), path)
    return routed.read_cluster_files(spark, path)


_WEIGHTS = "SELECT sample, cdr, CAST(sum(qty) AS BIGINT) AS weight, count(*) AS n_unique FROM found GROUP BY sample, cdr"


@query(_with(_FOUND, _WEIGHTS))
def cdr_weights(spark, sf_dir):
    return cdr3.cdr_weights(_found(spark, sf_dir))


@query(_with(_FOUND, f"SELECT sample, cdr, weight, row_number() OVER (PARTITION BY sample ORDER BY weight DESC, cdr) AS rank FROM ({_WEIGHTS}) w"))
def cdr_rank(spark, sf_dir):
    return cdr3.cdr_rank(cdr3.cdr_weights(_found(spark, sf_dir))).drop("n_unique")


@query(_with(_FOUND, "SELECT DISTINCT sample, cdr FROM found WHERE length(cdr) % 3 = 0"))
def cdr_in_frame(spark, sf_dir):
    return _found(spark, sf_dir).where("length(cdr) % 3 = 0").select("sample", "cdr").distinct()


@query(_with(_FOUND, f"SELECT f.sample, f.cdr, f.seq, f.qty, w.weight FROM found f JOIN ({_WEIGHTS}) w ON f.sample = w.sample AND f.cdr = w.cdr"))
def cdr_full_reads(spark, sf_dir):
    found = _found(spark, sf_dir).where("cdr IS NOT NULL")
    return found.join(cdr3.cdr_weights(found), ["sample", "cdr"]).select("sample", "cdr", "seq", "qty", "weight")


# --- duplicates and counts ----------------------------------------------------------


@query("SELECT sample, seq, count(*) AS qty FROM ok GROUP BY sample, seq")
def dedup_exact(spark, sf_dir):
    return dedup.dedup_exact(synth.ok_reads(spark, sf_dir))


@query("SELECT text, count(*) AS qty, 'd' AS sample FROM documents WHERE text IS NOT NULL GROUP BY text", reads=False)
def dedup_exact_documents(spark, sf_dir):
    return dedup.dedup_exact(_table(spark, sf_dir, "documents").select("text", F.lit("d").alias("sample")), seq="text")


@query("SELECT o_custkey AS read_id, max(o_orderkey) AS ord, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey", reads=False)
def dedup_last_by_id(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("read_id"), F.col("o_orderkey").alias("ord"), F.col("o_totalprice").alias("price"))
    return dedup.dedup_last_by_id(rows)


@query("SELECT sample, seq, qty, 'Seq' || CAST(row_number() OVER (PARTITION BY sample ORDER BY seq) AS VARCHAR) || '_' || CAST(qty AS VARCHAR) AS uid FROM uniq")
def assign_ids(spark, sf_dir):
    return dedup.assign_ids(synth.unique(spark, sf_dir).select("sample", "seq", "qty"))


@query("SELECT sample, clone, CASE WHEN count(*) = 1 THEN 1 ELSE CAST(sum(qty) AS BIGINT) END AS qty, CAST(sum(qty) AS BIGINT) AS n_reads FROM uniq GROUP BY sample, clone")
def cluster_abundance(spark, sf_dir):
    return consensus.cluster_abundance(synth.unique(spark, sf_dir), ["sample", "clone"])


@query("SELECT sample, clone, count(*) AS n FROM uniq GROUP BY sample, clone")
def cluster_sizes(spark, sf_dir):
    return synth.unique(spark, sf_dir).groupBy("sample", "clone").agg(F.count("*").alias("n"))


# --- similarity ---------------------------------------------------------------------

_KMER_ROWS = "SELECT sample, seq, substring(seq, CAST(i AS INT), 11) AS kmer FROM (SELECT sample, seq, unnest(range(1, length(seq) - 9)) AS i FROM cdrs) x"
_CDRS = f"{_FOUND}, cdrs AS MATERIALIZED (SELECT DISTINCT sample, cdr AS seq FROM found)"
_SHARED = f"{_CDRS}, counts AS MATERIALIZED (SELECT sample, seq, kmer, count(*) AS n FROM ({_KMER_ROWS}) k GROUP BY ALL), shared AS (SELECT a.sample, a.seq AS src, b.seq AS dst, CAST(sum(least(a.n, b.n)) AS BIGINT) AS shared FROM counts a JOIN counts b ON a.sample = b.sample AND a.kmer = b.kmer AND a.seq < b.seq GROUP BY ALL)"


def _cdrs(spark, sf_dir):
    return _found(spark, sf_dir).where("cdr IS NOT NULL").select("sample", F.col("cdr").alias("seq")).distinct()


@query(_with(_SHARED, "SELECT * FROM shared"))
def shared_kmers(spark, sf_dir):
    return simjoin.shared_kmers(_cdrs(spark, sf_dir), 11)


@query(
    _with(
        _SHARED,
        "SELECT a.sample, a.seq AS src, b.seq AS dst, CAST(coalesce(s.shared, 0) AS BIGINT) AS shared FROM (SELECT DISTINCT sample, cdr AS seq FROM found WHERE cdr IS NOT NULL) a "
        "JOIN (SELECT DISTINCT sample, cdr AS seq FROM found WHERE cdr IS NOT NULL) b ON a.sample = b.sample AND a.seq < b.seq LEFT JOIN shared s ON s.sample = a.sample AND s.src = a.seq AND s.dst = b.seq "
        "WHERE coalesce(s.shared, 0) >= greatest(length(a.seq), length(b.seq)) - 10 - 2 * 21",
    )
)
def kmer_prefilter(spark, sf_dir):
    return simjoin.kmer_prefilter(_cdrs(spark, sf_dir), 11, 2)


@query("SELECT DISTINCT sample, substring(true_core, CAST(i AS INT), 11) AS kmer FROM (SELECT sample, true_core, unnest(range(1, length(true_core) - 9)) AS i FROM uniq) x")
def trusted_kmers(spark, sf_dir):
    return correct.trusted_kmers(synth.unique(spark, sf_dir), seq="true_core")


@query("SELECT u.sample, u.seq, count(t.kmer) AS n_trusted FROM (SELECT sample, seq, substring(seq, CAST(i AS INT), 11) AS kmer FROM (SELECT sample, seq, unnest(range(1, length(seq) - 9)) AS i FROM uniq) x) u LEFT JOIN (SELECT DISTINCT sample, substring(true_core, CAST(i AS INT), 11) AS kmer FROM (SELECT sample, true_core, unnest(range(1, length(true_core) - 9)) AS i FROM uniq) y) t ON t.sample = u.sample AND t.kmer = u.kmer GROUP BY u.sample, u.seq")
def trusted_kmer_count(spark, sf_dir):
    rows = synth.unique(spark, sf_dir)
    return correct.trusted_kmer_count(rows, correct.trusted_kmers(rows, seq="true_core"))


_NAMES = "SELECT DISTINCT p_name AS seq FROM part"


def _names(spark, sf_dir):
    return _table(spark, sf_dir, "part").select(F.lit("p").alias("sample"), F.col("p_name").alias("seq"))


_NAME_PAIRS = f"WITH n AS ({_NAMES}) SELECT a.seq AS src, b.seq AS dst, CAST(levenshtein(a.seq, b.seq) AS BIGINT) AS dist, 'p' AS sample FROM n a JOIN n b ON a.seq < b.seq"


@query(_NAME_PAIRS, reads=False)
def levenshtein_pairs(spark, sf_dir):
    n = _names(spark, sf_dir).distinct()
    both = n.select("sample", F.col("seq").alias("src")).join(n.select(F.col("sample").alias("s"), F.col("seq").alias("dst")), (F.col("sample") == F.col("s")) & (F.col("src") < F.col("dst")))
    return both.select("src", "dst", F.levenshtein("src", "dst").cast("long").alias("dist"), "sample")


@query(f"SELECT * FROM ({_NAME_PAIRS}) p WHERE dist <= 2", reads=False)
def edit_distance_join(spark, sf_dir):
    return simjoin.edit_distance_join(_names(spark, sf_dir), 2)


@query(_with(_CDRS, "SELECT a.sample, a.seq AS src, b.seq AS dst, CAST(levenshtein(a.seq, b.seq) AS BIGINT) AS dist FROM cdrs a JOIN cdrs b ON a.sample = b.sample AND a.seq < b.seq WHERE levenshtein(a.seq, b.seq) <= 2"))
def edit_join_blocked(spark, sf_dir):
    return simjoin.edit_distance_join(_cdrs(spark, sf_dir), 2)


@query(f"SELECT * FROM ({_NAME_PAIRS}) p ORDER BY dist, src, dst LIMIT 1", reads=False)
def closest_pair(spark, sf_dir):
    return simjoin.closest_pair(_names(spark, sf_dir))


_COMPONENTS = """WITH RECURSIVE n AS MATERIALIZED ({nodes}), e AS MATERIALIZED (SELECT a.g, a.seq AS a, b.seq AS b FROM n a JOIN n b ON a.g = b.g AND a.seq <> b.seq AND levenshtein(a.seq, b.seq) <= 2),
  reach AS (SELECT g, seq AS a, seq AS b FROM n UNION SELECT r.g, r.a, e.b FROM reach r JOIN e ON r.g = e.g AND r.b = e.a)
SELECT g AS sample, a AS seq, min(b) AS cluster FROM reach GROUP BY g, a"""


@query("SELECT seq, cluster FROM (" + _COMPONENTS.format(nodes="SELECT 'p' AS g, seq FROM (SELECT DISTINCT p_name AS seq FROM part) x") + ") c WHERE seq <> cluster OR seq IN (SELECT a.p_name FROM part a JOIN part b ON a.p_name <> b.p_name AND levenshtein(a.p_name, b.p_name) <= 2)", reads=False)
def connected_components(spark, sf_dir):
    edges = simjoin.edit_distance_join(_names(spark, sf_dir), 2)
    return components_of(edges).select(F.col("node").alias("seq"), F.col("component").alias("cluster"))


@query("SELECT * FROM (" + _COMPONENTS.format(nodes=_with(_FOUND, "SELECT DISTINCT sample AS g, cdr AS seq FROM found")) + ") c", reads=False)
def graph_cluster(spark, sf_dir):
    return cluster.graph_cluster(_cdrs(spark, sf_dir), 2)


@query(_with(_FOUND, "SELECT a.sample, a.clone AS cluster_a, b.clone AS cluster_b, avg(CAST(levenshtein(a.cdr, b.cdr) AS DOUBLE)) AS avg_dist FROM (SELECT DISTINCT sample, clone, cdr FROM found) a JOIN (SELECT DISTINCT sample, clone, cdr FROM found) b ON a.sample = b.sample AND a.clone < b.clone GROUP BY ALL"))
def avg_linkage_distance(spark, sf_dir):
    rows = _found(spark, sf_dir).where("cdr IS NOT NULL").select("sample", "clone", "cdr").distinct()
    return cluster.cluster_pair_distances(rows, cluster="clone", seq="cdr")


# --- clusters with a planted truth --------------------------------------------------


@query("SELECT sample, seq, min(seq) OVER (PARTITION BY sample, clone) AS part FROM uniq")
def hier_cluster(spark, sf_dir):
    rows = synth.unique(spark, sf_dir).select("sample", "seq", F.col("clone").alias("cluster"))
    return cluster.hierarchical_cluster(rows).select("sample", "seq", "part")


def _turned(places: tuple[int, ...]) -> str:
    """SQL of ``true_core`` with the bases at some places turned into their complements."""
    out, at = [], 1
    for p in places:
        out += [f"substring(true_core, {at}, {p - at})", f"translate(substring(true_core, {p}, 1), 'ACGT', 'TGCA')"]
        at = p + 1
    return " || ".join([*out, f"substring(true_core, {at}, 1000)"])


#: Of each clone three sequences, 2, 4 and 6 edits apart: the first two join, then the mean of 4 and 6 keeps the third out.
_CHAIN = f"SELECT DISTINCT sample, CAST(clone % 12 AS BIGINT) AS cluster, true_core AS v0, {_turned((10, 30))} AS v1, {_turned((10, 30, 50, 70, 90, 110))} AS v2 FROM uniq"


@query(f"SELECT sample, seq, part FROM (SELECT sample, unnest([v0, v1, v2]) AS seq, unnest([least(v0, v1), least(v0, v1), v2]) AS part FROM ({_CHAIN}) c) x")
def hier_cluster_split(spark, sf_dir):
    """Groups of several clones, each a chain that average linkage cuts."""
    chain = spark.sql(_CHAIN.replace("FROM uniq", "FROM {uniq}"), uniq=synth.unique(spark, sf_dir))
    rows = chain.select("sample", "cluster", F.explode(F.array("v0", "v1", "v2")).alias("seq"))
    return cluster.hierarchical_cluster(rows).select("sample", "seq", "part")


@query(_with(_FOUND, "SELECT f.sample, f.seq, f.cdr, t.cdr AS true_cdr FROM found f JOIN (SELECT sample, clone, arg_min(cdr, (-weight, cdr)) AS cdr FROM (SELECT sample, clone, cdr, sum(qty) AS weight FROM found GROUP BY ALL) w GROUP BY sample, clone) t ON t.sample = f.sample AND t.clone = f.clone"))
def cdr_correct(spark, sf_dir):
    found = _found(spark, sf_dir).where("cdr IS NOT NULL").withColumnRenamed("clone", "cluster")
    return correct.correct_cdrs(found.select("sample", "cluster", "cdr", "seq", "qty")).select("sample", "seq", "cdr", "true_cdr")


@query(_with(_FOUND, "SELECT a.sample, a.cdr AS c1, b.cdr AS c2, CASE WHEN CAST(a.weight AS DOUBLE) / b.weight >= 2 THEN a.cdr WHEN length(a.cdr) % 3 <> 0 AND length(b.cdr) % 3 = 0 THEN b.cdr ELSE a.cdr END AS chosen FROM w a JOIN w b ON a.sample = b.sample AND a.clone = b.clone AND (a.weight > b.weight OR (a.weight = b.weight AND a.cdr < b.cdr))").replace("\nSELECT a.sample", ", w AS (SELECT sample, clone, cdr, CAST(sum(qty) AS BIGINT) AS weight FROM found GROUP BY ALL)\nSELECT a.sample"))
def choose_true(spark, sf_dir):
    w = cdr3.cdr_weights(_found(spark, sf_dir), ("sample", "clone"))
    a = w.select("sample", "clone", F.col("cdr").alias("c1"), F.col("weight").alias("w1"))
    b = w.select("sample", "clone", F.col("cdr").alias("c2"), F.col("weight").alias("w2"))
    pairs = a.join(b, ["sample", "clone"]).where("w1 > w2 OR (w1 = w2 AND c1 < c2)")
    return pairs.select("sample", "c1", "c2", correct.choose_true(F.col("c1"), F.col("w1"), F.col("c2"), F.col("w2"), 2.0).alias("chosen"))


_ALIGNED = "SELECT sample || '_' || CAST(clone AS VARCHAR) AS cluster_id, CASE WHEN length(seq) < length(true_core) THEN substring(seq, 1, 41) || '-' || substring(seq, 42) ELSE seq END AS aln, qty, true_core FROM uniq"


def _aligned(spark, sf_dir):
    aln = F.when(F.length("seq") < F.length("true_core"), F.concat(F.substring("seq", 1, 41), F.lit("-"), F.substring("seq", 42, 1 << 20))).otherwise(F.col("seq"))
    return synth.unique(spark, sf_dir).select(F.concat_ws("_", "sample", F.col("clone").cast("string")).alias("cluster_id"), aln.alias("aln"), "qty", "true_core")


@query(f"SELECT cluster_id, string_agg(CASE WHEN ch = '-' THEN '' ELSE ch END, '' ORDER BY pos) AS consensus FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id, pos ORDER BY w DESC, ch = '-', ch) AS n FROM (SELECT cluster_id, pos, ch, sum(qty) AS w FROM (SELECT cluster_id, qty, i AS pos, substring(aln, CAST(i AS INT), 1) AS ch FROM (SELECT *, unnest(range(1, length(aln) + 1)) AS i FROM ({_ALIGNED}) a) b) c GROUP BY ALL) d) e WHERE n = 1 GROUP BY cluster_id")
def consensus_plurality(spark, sf_dir):
    return consensus.consensus_plurality(_aligned(spark, sf_dir))


@query(f"SELECT cluster_id, aln, CAST(len(list_filter(range(1, length(aln) + 1), lambda i: substring(aln, CAST(i AS INT), 1) <> substring(true_core, CAST(i AS INT), 1))) AS BIGINT) AS n_diff FROM ({_ALIGNED}) a")
def aligned_mismatches(spark, sf_dir):
    return _aligned(spark, sf_dir).select("cluster_id", "aln", align.aligned_mismatches(F.col("aln"), F.col("true_core")).alias("n_diff"))


# --- alignment ----------------------------------------------------------------------


def _pairs(spark, sf_dir):
    return synth.unique(spark, sf_dir).select("sample", F.col("true_core").alias("a"), F.col("seq").alias("b"))


@query("SELECT sample, true_core AS a, seq AS b, CASE WHEN length(seq) < length(true_core) THEN -2 WHEN seq = true_core THEN 0 ELSE -1 END AS score FROM uniq")
def global_align(spark, sf_dir):
    return _pairs(spark, sf_dir).withColumn("g", align.global_align(F.col("a"), F.col("b"))).select("sample", "a", "b", "g.score")


@query("SELECT sample, true_core AS a, seq AS b, CASE WHEN seq = true_core THEN 0 ELSE 1 END AS dist FROM uniq")
def align_edit_dist(spark, sf_dir):
    return _pairs(spark, sf_dir).select("sample", "a", "b", align.align_edit_distance(F.col("a"), F.col("b")).alias("dist"))


@query("SELECT sample, true_core AS a, seq AS b, CASE WHEN length(seq) < length(true_core) THEN -2 WHEN seq = true_core THEN 0 ELSE -1 END AS score FROM uniq")
def align_nonmutual(spark, sf_dir):
    return _pairs(spark, sf_dir).withColumn("g", align.nonmutual_align(F.col("a"), F.col("b"))).select("sample", "a", "b", "g.score")


@query("SELECT sample, seq, CAST(40 + clone % 20 AS INT) AS score, CAST(100 + clone % 37 AS INT) AS start_a FROM uniq")
def local_align(spark, sf_dir):
    """A piece of each read, of 40 to 59 bases from 100 to 136 on, between letters that match nothing."""
    piece = F.substring(F.col("seq"), (F.lit(101) + F.col("clone") % 37).cast("int"), (F.lit(40) + F.col("clone") % 20).cast("int"))
    rows = synth.unique(spark, sf_dir).withColumn("g", align.local_align(F.col("seq"), F.concat(F.lit("----"), piece, F.lit("--"))))
    return rows.select("sample", "seq", "g.score", "g.start_a")


# --- demultiplexing -----------------------------------------------------------------


def _demuxed(spark, sf_dir):
    return demux.demultiplex(synth.reads(spark, sf_dir).select("read_id", "seq"), synth.config(spark))


@query("SELECT read_id, sample, status FROM reads")
def demux_assign(spark, sf_dir):
    return _demuxed(spark, sf_dir).select("read_id", "sample", "status")


@query("SELECT read_id, seq FROM reads WHERE status IN ('nomid', 'has_n')")
def demux_unassigned(spark, sf_dir):
    return _demuxed(spark, sf_dir).where("sample IS NULL").select("read_id", F.col("out_seq").alias("seq"))


@query("SELECT sample, status, count(*) AS n_reads FROM reads GROUP BY sample, status")
def demux_summary(spark, sf_dir):
    return demux.demux_summary(_demuxed(spark, sf_dir), synth.config(spark))


@query("SELECT read_id, sample, core AS clipped FROM reads WHERE status = 'ok'")
def primer_clip(spark, sf_dir):
    return _demuxed(spark, sf_dir).where("status = 'ok'").select("read_id", "sample", F.col("out_seq").alias("clipped"))


# --- the whole ----------------------------------------------------------------------

@query("SELECT sample, 'p' || CAST(clone AS VARCHAR) AS cluster, min(true_core) AS seq, CAST(count(DISTINCT seq) + 1 AS BIGINT) AS n_reads FROM uniq WHERE seq <> true_core GROUP BY sample, clone")
def pair_consensus(spark, sf_dir):
    """Clusters of two single reads, made of the first two variants of each clone, resolved by trusted k-mers."""
    u = materialise(synth.unique(spark, sf_dir).select("sample", "seq", F.lit(1).cast("long").alias("qty"), "clone", "true_core"))
    pairs = u.where("seq <> true_core").select("sample", F.concat(F.lit("p"), F.col("clone").cast("string")).alias("cluster"), F.explode(F.array("seq", "true_core")).alias("seq"), "qty").distinct()
    whole = u.select("sample", F.concat(F.lit("w"), F.col("clone").cast("string")).alias("cluster"), F.col("true_core").alias("seq"), F.lit(9).cast("long").alias("qty")).distinct()
    more = u.where("seq <> true_core").select("sample", F.concat(F.lit("w"), F.col("clone").cast("string")).alias("cluster"), "seq", "qty")
    out = correct.correct_reads(pairs.unionByName(whole).unionByName(more))
    return out.where("cluster LIKE 'p%'").select("sample", "cluster", "seq", "n_reads")


#: What was planted: a clone's reads give its core, as at every place most of them have it.
_TRUTH = "SELECT sample, clone, min(true_core) AS seq, CASE WHEN count(*) = 1 THEN 1 ELSE CAST(sum(qty) AS BIGINT) END AS qty, CAST(sum(qty) AS BIGINT) AS n_reads FROM uniq GROUP BY sample, clone"


@query(f"SELECT sample, CAST(clone AS VARCHAR) AS cluster, seq, qty, n_reads FROM ({_TRUTH}) t")
def read_correct(spark, sf_dir):
    rows = synth.unique(spark, sf_dir).select("sample", F.col("clone").cast("string").alias("cluster"), "seq", "qty")
    return correct.correct_reads(rows).select("sample", "cluster", "seq", "qty", "n_reads")


@query(_with(_FOUND, f"SELECT t.sample, f.cdr, t.seq, t.qty, t.n_reads FROM ({_TRUTH}) t JOIN found f ON f.sample = t.sample AND f.seq = t.seq"))
def pipeline_reads(spark, sf_dir):
    return flagship(spark, sf_dir)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected sequences of all samples, from raw reads."""
    return pipeline.run(synth.reads(spark, sf_dir), synth.config(spark))
