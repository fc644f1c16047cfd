"""All queries over the test tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cigar, locus
from ..functions import reads as names
from ..operators import assign, dedup, density, filters, genemodel, identifiers, matrix, metrics, overlap, ranking, saturation
from ..operators import expression as counts
from ..session import new_folder, settled
from ..sources import annotation, bam, sinks
from . import views
from .views import GENES_SQL, LINES_SQL, READS_SQL, identifiers_sql

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
LONG = "bigint"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- reads: filters and names -------------------------------------------------------------


@query(f"WITH {READS_SQL} SELECT rec_idx FROM reads_v WHERE hi IS NULL OR hi = 1")
def hi_filter(spark, sf_dir):
    return views.reads(spark, sf_dir).filter(filters.primary(F.col("hi"))).select("rec_idx")


@query(f"WITH {READS_SQL} SELECT rec_idx, CASE WHEN mapq >= 10 THEN 'keep' ELSE 'lowq' END AS status FROM reads_v")
def mapq_split(spark, sf_dir):
    return filters.quality(views.reads(spark, sf_dir), 10, keep=True).select("rec_idx", "status")


@query(f"WITH {READS_SQL} SELECT rec_idx, CAST(CASE WHEN mapq >= 10 THEN flag ELSE flag | 512 END AS INT) AS flag FROM reads_v")
def flag_lq(spark, sf_dir):
    return filters.quality(views.reads(spark, sf_dir), 10, keep=True).select("rec_idx", "flag")


@query(f"WITH {READS_SQL} SELECT rec_idx, cb, ur, '' AS uy FROM named_v")
def qname_parse(spark, sf_dir):
    return filters.with_names(views.reads(spark, sf_dir)).select("rec_idx", "cb", "ur", "uy")


@query(f"WITH {READS_SQL} SELECT rec_idx, concat('E', rec_idx) AS qname FROM reads_v")
def qname_strip(spark, sf_dir):
    return filters.with_names(views.reads(spark, sf_dir)).select("rec_idx", "qname")


@query(f"WITH {READS_SQL} SELECT rec_idx FROM named_v WHERE NOT contains(replace(ur, 'TT', 'NT'), 'N')")
def umi_n_filter(spark, sf_dir):
    r = filters.with_names(views.reads(spark, sf_dir)).withColumn("ur", F.replace("ur", F.lit("TT"), F.lit("NT")))
    return r.filter(filters.clear_identifier(F.col("ur"))).select("rec_idx")


_ODD = "CASE event_id % 5 WHEN 0 THEN 'random' WHEN 1 THEN 'chrU' WHEN 2 THEN 'chrUn' WHEN 3 THEN NULL ELSE 'chr1' END"


@query(f"SELECT event_id AS rec_idx FROM (SELECT event_id, {_ODD} AS contig FROM events) WHERE contig IN ('chrUn', 'chr1')")
def exclude_contigs(spark, sf_dir):
    r = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id AS rec_idx", f"{_ODD} AS contig")
    return r.filter(filters.included(F.col("contig"))).select("rec_idx")


@query(f"WITH {READS_SQL} SELECT CAST(rec_idx % 2 AS INT) AS file_idx, contig, count(*) AS n FROM reads_v GROUP BY 1, 2")
def union_files(spark, sf_dir):
    r = views.reads(spark, sf_dir)
    both = filters.union_files([r.filter(f"rec_idx % 2 = {k}") for k in (0, 1)])
    return both.groupBy("file_idx", "contig").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {READS_SQL} SELECT rec_idx FROM reads_v WHERE contig = 'chr2'")
def contig_scan(spark, sf_dir):
    return filters.on_contig(views.reads(spark, sf_dir), "chr2").select("rec_idx")


_OPS = """ops_v AS (SELECT rec_idx, pos, generate_subscripts(l, 1) AS i, CAST(unnest(l) AS INT) AS len, unnest(o) AS op
  FROM (SELECT rec_idx, pos, regexp_extract_all(cigar, '(\\d+)[MIDNSHP=X]', 1) AS l, regexp_extract_all(cigar, '\\d+([MIDNSHP=X])', 1) AS o FROM reads_v)),
len_v AS (SELECT rec_idx, CAST(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) AS INT) AS ref_len FROM ops_v GROUP BY 1)"""
_BLOCKS = """moved_v AS (SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len END) OVER w, 0) AS r, coalesce(sum(CASE WHEN op IN ('M', 'I', 'S', '=', 'X') THEN len END) OVER w, 0) AS d
  FROM ops_v WINDOW w AS (PARTITION BY rec_idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
blocks_v AS (SELECT rec_idx, i, CAST(1 + d AS INT) AS read_start, CAST(pos + 1 + r AS INT) AS ref_start, len FROM moved_v WHERE op IN ('M', '=', 'X'))"""


@query(f"WITH {READS_SQL}, {_OPS} SELECT r.rec_idx FROM reads_v r JOIN len_v USING (rec_idx) WHERE contig = 'chr1' AND pos < 30000 AND pos + ref_len > 20000")
def range_scan(spark, sf_dir):
    return filters.in_range(views.reads(spark, sf_dir), "chr1", 20000, 30000, cigar.reference_length(cigar.operations(F.col("cigar")))).select("rec_idx")


@query(f"WITH {READS_SQL} SELECT rec_idx, contig FROM reads_v WHERE contig = 'chr2' ORDER BY rec_idx LIMIT 1")
def first_record(spark, sf_dir):
    contigs = spark.createDataFrame([(0, "chrU"), (1, "chr2"), (2, "chr1"), (3, "chr3")], "contig_idx int, contig string")
    return filters.first_read(views.reads(spark, sf_dir), contigs).select("rec_idx", "contig")


@query(f"WITH {READS_SQL}, {_OPS} SELECT rec_idx, CAST(i AS INT) AS i, len, op FROM ops_v")
def cigar_ops(spark, sf_dir):
    r = views.reads(spark, sf_dir).select("rec_idx", F.posexplode(cigar.operations(F.col("cigar"))).alias("i", "o"))
    return r.select("rec_idx", (F.col("i") + 1).alias("i"), "o.len", "o.op")


@query(f"WITH {READS_SQL}, {_OPS} SELECT rec_idx, ref_len FROM len_v")
def cigar_ref_length(spark, sf_dir):
    return views.reads(spark, sf_dir).select("rec_idx", cigar.reference_length(cigar.operations(F.col("cigar"))).alias("ref_len"))


@query(f"WITH {READS_SQL}, {_OPS}, {_BLOCKS} SELECT rec_idx, read_start, ref_start, len FROM blocks_v")
def cigar_blocks(spark, sf_dir):
    return assign.with_places(views.reads(spark, sf_dir)).select("rec_idx", F.inline("blocks"))


@query(f"WITH {READS_SQL} SELECT rec_idx, CASE WHEN isize < 0 THEN concat(mpos - isize, mpos) ELSE concat(pos, pos + isize) END AS marker FROM reads_v")
def position_marker(spark, sf_dir):
    return views.reads(spark, sf_dir).select("rec_idx", names.marker(F.col("pos"), F.col("mpos"), F.col("isize")).alias("marker"))


@query(f"WITH {READS_SQL} SELECT rec_idx, CAST(split_part(cb, '_', 3) AS INT) AS row, CAST(split_part(cb, '_', 4) AS INT) AS col, concat(CAST(split_part(cb, '_', 3) AS INT) // 150, '_', CAST(split_part(cb, '_', 4) AS INT) // 150) AS bin FROM named_v")
def barcode_bins(spark, sf_dir):
    b = F.col("cb")
    return filters.with_names(views.reads(spark, sf_dir)).select("rec_idx", names.barcode_row(b).alias("row"), names.barcode_column(b).alias("col"), saturation.spatial_bin(b).alias("bin"))


@query("SELECT event_id AS rec_idx, part FROM (SELECT event_id, unnest(string_split(concat('a__', event_type, '_', event_id % 3, '_'), '_')) AS part FROM events) WHERE part <> ''")
def split_nonempty(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(F.col("event_id").alias("rec_idx"), F.explode(names.split_nonempty(F.concat(F.lit("a__"), "event_type", F.lit("_"), (F.col("event_id") % 3).cast("string"), F.lit("_")), "_")).alias("part"))


# ---- annotation and gene model ------------------------------------------------------------


def _annotation(spark, sf_dir):
    return annotation.gtf(views.gtf_lines(spark, sf_dir))


@query(f'WITH {LINES_SQL} SELECT line_no, contig, feature, start, "end", strand, gene_id, gene_name, transcript_id FROM lines_v')
def gtf_attrs(spark, sf_dir):
    return _annotation(spark, sf_dir).select("line_no", "contig", "feature", "start", "end", "strand", "gene_id", "gene_name", "transcript_id")


_GFF = "CASE event_id % 7 WHEN 0 THEN 'region' WHEN 1 THEN 'gene' WHEN 2 THEN 'mRNA' WHEN 4 THEN 'CDS' ELSE 'exon' END"


@query(f"""WITH l AS (SELECT event_id AS line_no, {_GFF} AS feature FROM events),
g AS (SELECT *, sum(CASE WHEN feature = 'region' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS region FROM l),
f AS (SELECT *, max(CASE WHEN feature = 'gene' THEN line_no END) OVER w AS gene_at, max(CASE WHEN feature = 'mRNA' THEN line_no END) OVER w AS tx_at FROM g WINDOW w AS (PARTITION BY region ORDER BY line_no))
SELECT line_no, feature, concat('g', gene_at) AS gene_id, concat('N', gene_at % 50) AS gene_name, CASE WHEN tx_at >= gene_at AND feature <> 'gene' THEN concat('t', tx_at) ELSE '' END AS transcript_id FROM f WHERE gene_at IS NOT NULL""")
def gff_forward_fill(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id AS line_no", f"{_GFF} AS feature")
    attributes = F.when(F.col("feature") == "gene", F.format_string("ID=g%d;Name=N%d", "line_no", F.col("line_no") % 50)).when(F.col("feature") == "mRNA", F.format_string("ID=t%d;Parent=x", "line_no")).otherwise(F.lit("Parent=y"))
    lines = e.select("line_no", F.concat(F.lit("chr1\tx\t"), "feature", F.lit("\t1\t2\t.\t+\t.\t"), attributes).alias("value"))
    return annotation.gff(lines).select("line_no", "feature", "gene_id", "gene_name", "transcript_id")


@query(f"""WITH l AS (SELECT event_id AS line_no, {_GFF} AS feature FROM events),
g AS (SELECT *, sum(CASE WHEN feature = 'region' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS region FROM l),
f AS (SELECT *, max(CASE WHEN feature = 'gene' THEN line_no END) OVER w AS gene_at, max(CASE WHEN feature = 'mRNA' THEN line_no END) OVER w AS tx_at FROM g WINDOW w AS (PARTITION BY region ORDER BY line_no)),
t AS (SELECT DISTINCT gene_at // 7 % 300 AS gene, tx_at, (tx_at // 7) * (tx_at // 7) // 7 % 40 AS name FROM f WHERE tx_at >= gene_at AND feature <> 'gene')
SELECT DISTINCT concat('N', gene) AS gene_name FROM (SELECT gene, name FROM t GROUP BY 1, 2 HAVING count(*) > 1)""")
def gff_repeated_names(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id AS line_no", f"{_GFF} AS feature")
    k = F.floor(F.col("line_no") / 7)
    attributes = F.when(F.col("feature") == "gene", F.format_string("ID=g%d;Name=N%d", "line_no", k % 300)).when(F.col("feature") == "mRNA", F.format_string("ID=t%d;Name=m%d", "line_no", F.floor(k * k / 7) % 40)).otherwise(F.lit("Parent=y"))
    lines = e.select("line_no", F.concat(F.lit("chr1\tx\t"), "feature", F.lit("\t1\t2\t.\t+\t.\t"), attributes).alias("value"))
    return genemodel.repeated_names(genemodel.contig_runs(annotation.gff(lines)))


_RUNS = LINES_SQL + """, lag_v AS (SELECT *, CASE WHEN contig = lag(contig) OVER (PARTITION BY gene_name ORDER BY line_no) THEN 0 ELSE 1 END AS fresh FROM lines_v),
runs_v AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY gene_name ORDER BY line_no) AS INT) AS run FROM lag_v),
extent_v AS (SELECT gene_name, run, min(line_no) AS gene_ord, arg_min(contig, line_no) AS contig, arg_min(gene_id, line_no) AS gene_id, min(start) AS start, max("end") AS "end", arg_min(strand, line_no) = '-' AS neg_strand, count(DISTINCT gene_id) AS n_ids FROM runs_v GROUP BY 1, 2),
exon_v AS (SELECT *, lag("end") OVER (PARTITION BY gene_name, run, transcript_id ORDER BY start, "end") AS before FROM runs_v WHERE feature = 'exon' AND transcript_id <> ''),
tx_v AS (SELECT gene_name, run, transcript_id AS transcript_key, min(start) AS tx_start, max("end") AS tx_end, max(CASE WHEN before > start THEN 1 ELSE 0 END) AS crossing, max(CASE WHEN start > "end" THEN 1 ELSE 0 END) AS backward FROM exon_v GROUP BY 1, 2, 3),
cds_v AS (SELECT gene_name, run, transcript_id AS transcript_key, min(start) AS cs, max("end") AS ce FROM runs_v WHERE feature = 'CDS' AND transcript_id <> '' GROUP BY 1, 2, 3),
model_v AS (SELECT t.*, coalesce(cs, tx_start) AS cds_start, coalesce(ce, tx_end) AS cds_end FROM tx_v t LEFT JOIN cds_v USING (gene_name, run, transcript_key)),
bad_v AS (SELECT e.gene_name, CAST(max(CASE WHEN n_ids > 1 THEN 1 ELSE 0 END) AS INT) AS several_ids,
  CAST(coalesce(max(o.off), 0) AS INT) AS extent_differs, CAST(max(n.nt) AS INT) AS no_transcript_id, CAST(max(CASE WHEN c.k IS NULL THEN 1 ELSE 0 END) AS INT) AS no_transcripts,
  CAST(coalesce(max(d.twice), 0) AS INT) AS name_repeated, CAST(coalesce(max(c.backward), 0) AS INT) AS exon_backward, CAST(coalesce(max(c.crossing), 0) AS INT) AS exons_overlap FROM extent_v e
  LEFT JOIN (SELECT r.gene_name, max(CASE WHEN r.start <> x.start OR r."end" <> x."end" THEN 1 ELSE 0 END) AS off FROM runs_v r JOIN extent_v x USING (gene_name, run) WHERE r.feature = 'gene' GROUP BY 1) o USING (gene_name)
  LEFT JOIN (SELECT gene_name, max(CASE WHEN feature <> 'gene' AND transcript_id = '' THEN 1 ELSE 0 END) AS nt FROM runs_v GROUP BY 1) n USING (gene_name)
  LEFT JOIN (SELECT gene_name, max(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS twice FROM (SELECT gene_name, run, transcript_id AS name, count(DISTINCT transcript_id) AS n FROM runs_v WHERE feature <> 'gene' AND transcript_id <> '' GROUP BY 1, 2, 3) GROUP BY 1) d USING (gene_name)
  LEFT JOIN (SELECT gene_name, run, count(*) AS k, max(crossing) AS crossing, max(backward) AS backward FROM tx_v GROUP BY 1, 2) c ON c.gene_name = e.gene_name AND c.run = e.run GROUP BY 1)"""


@query(f"WITH {_RUNS} SELECT line_no, gene_name, run FROM runs_v")
def gene_contig_runs(spark, sf_dir):
    return genemodel.contig_runs(_annotation(spark, sf_dir)).select("line_no", "gene_name", "run")


@query(f"WITH {_RUNS} SELECT * FROM extent_v")
def gene_extent(spark, sf_dir):
    return genemodel.gene_extents(genemodel.contig_runs(_annotation(spark, sf_dir)))


@query(f"WITH {_RUNS} SELECT *, greatest(several_ids, extent_differs, no_transcript_id, no_transcripts, name_repeated, exon_backward, exons_overlap) AS invalid FROM bad_v")
def gene_validation(spark, sf_dir):
    return genemodel.validation(_annotation(spark, sf_dir))


@query(f"WITH {_RUNS} SELECT gene_name, run, transcript_key, tx_start, tx_end, cds_start, cds_end, crossing = 1 AS crossing, backward = 1 AS backward FROM model_v")
def transcript_model(spark, sf_dir):
    return genemodel.transcript_models(genemodel.contig_runs(_annotation(spark, sf_dir))).drop("exons")


@query(f"""WITH {_RUNS}, valid_v AS (SELECT gene_name FROM bad_v WHERE greatest(several_ids, extent_differs, no_transcript_id, no_transcripts, name_repeated, exon_backward, exons_overlap) = 0)
SELECT e.gene_ord, e.contig, e.gene_name, e.start AS g_start, e."end" AS g_end, m.transcript_key, m.cds_start, m.cds_end, x.start AS exon_start, x."end" AS exon_end
FROM extent_v e JOIN valid_v USING (gene_name) JOIN model_v m ON m.gene_name = e.gene_name AND m.run = e.run JOIN exon_v x ON x.gene_name = e.gene_name AND x.run = e.run AND x.transcript_id = m.transcript_key""")
def gene_model(spark, sf_dir):
    g = genemodel.gene_model(_annotation(spark, sf_dir))
    t = g.select("gene_ord", "contig", "gene_name", F.col("start").alias("g_start"), F.col("end").alias("g_end"), F.inline("transcripts"))
    return t.select("gene_ord", "contig", "gene_name", "g_start", "g_end", "transcript_key", "cds_start", "cds_end", F.inline("exons").alias("exon_start", "exon_end"))


# ---- overlap and assignment ---------------------------------------------------------------

_PAIRS = f"""WITH {READS_SQL}, {GENES_SQL}, {_OPS}, {_BLOCKS}, placed_v AS (SELECT r.*, l.ref_len, r.pos + 1 AS b, r.pos + l.ref_len AS e FROM named_v r JOIN len_v l USING (rec_idx)),
pairs_v AS (SELECT r.rec_idx, r.b, r.e, g.*, g.neg_strand = ((r.flag & 16) <> 0) AS same FROM placed_v r JOIN genes_v g ON r.contig = g.contig AND g.start <= r.e AND g."end" >= r.b)"""
_BASES = _PAIRS + """, pb_v AS (SELECT p.*, k.i, k.len,
  greatest(0, least(k.ref_start + k.len - 1, p."end") - greatest(k.ref_start, p.start) + 1) AS clip,
  greatest(0, least(k.ref_start + k.len - 1, p.e1_end) - greatest(k.ref_start, p.e1_start) + 1) + greatest(0, least(k.ref_start + k.len - 1, p.e2_end) - greatest(k.ref_start, p.e2_start) + 1) AS ex,
  greatest(0, least(k.ref_start + k.len - 1, p.e1_end, p.cds_end) - greatest(k.ref_start, p.e1_start, p.cds_start) + 1) + greatest(0, least(k.ref_start + k.len - 1, p.e2_end, p.cds_end) - greatest(k.ref_start, p.e2_start, p.cds_start) + 1) AS cd
  FROM pairs_v p JOIN blocks_v k USING (rec_idx)),
gf_v AS (SELECT rec_idx, gene_ord, any_value(gene_name) AS gene, any_value(start) AS start, any_value(neg_strand) AS neg, bool_or(same) AS same, CAST(sum(ex) AS INT) AS exon, CAST(sum(clip - ex) AS INT) AS intron,
  CASE WHEN sum(ex) >= sum(len) // 2 THEN 5 WHEN sum(clip - ex) > 0 THEN 3 ELSE 1 END AS f2,
  max(CASE WHEN cd > 0 THEN 5 WHEN ex > 0 THEN 4 WHEN clip > 0 THEN 3 ELSE 1 END) AS f01, bool_or(ex > 0) AS hit FROM pb_v GROUP BY 1, 2)"""
_LABEL = "CASE {} WHEN 5 THEN 'EXONIC' WHEN 4 THEN 'UTR' WHEN 3 THEN 'INTRONIC' WHEN 1 THEN 'INTERGENIC' END"
_SIGN = "CASE WHEN {} THEN '-' ELSE '+' END"
_MODE2 = _BASES + f""", top_v AS (SELECT *, max(f2) OVER (PARTITION BY rec_idx) AS fmax FROM gf_v),
only_v AS (SELECT *, count(*) FILTER (WHERE f2 = fmax) OVER (PARTITION BY rec_idx) AS n_top FROM top_v),
pick_v AS (SELECT * FROM only_v QUALIFY row_number() OVER (PARTITION BY rec_idx ORDER BY CASE WHEN n_top = 1 AND f2 = fmax THEN 0 ELSE 1 END, exon DESC, intron DESC, start, gene_ord) = 1),
as_v AS (SELECT r.*, {_LABEL.format('f2')} AS xf, CASE WHEN f2 > 1 THEN gene END AS ge, CASE WHEN f2 > 1 THEN {_SIGN.format('neg')} END AS gs, coalesce(same, false) AS "right", coalesce(NOT same, false) AS wrong, false AS fixed, false AS rejected, f2 IS NULL AS nogene FROM placed_v r LEFT JOIN pick_v p USING (rec_idx))"""


def _settled(cand: str, top: str) -> str:
    return f""", cand_v AS ({cand}), sum_v AS (SELECT g.rec_idx, {top} AS top, count(*) FILTER (WHERE c.gene_ord IS NOT NULL AND g.same) AS ns, count(*) FILTER (WHERE c.gene_ord IS NOT NULL AND NOT g.same) AS no,
  max(g.gene) FILTER (WHERE c.gene_ord IS NOT NULL AND g.same) AS gene, bool_or(g.neg) FILTER (WHERE c.gene_ord IS NOT NULL AND g.same) AS neg FROM gf_v g LEFT JOIN cand_v c USING (rec_idx, gene_ord) GROUP BY 1),
as_v AS (SELECT r.*, {_LABEL.format('s.top')} AS xf, CASE WHEN ns = 1 THEN gene END AS ge, CASE WHEN ns = 1 THEN {_SIGN.format('neg')} END AS gs,
  coalesce(NOT (ns = 0 AND no > 0) AND NOT ns > 1, false) AS "right", coalesce(ns = 0 AND no > 0, false) AS wrong, coalesce(ns = 1 AND no > 0, false) AS fixed, coalesce(ns > 1, false) AS rejected, s.rec_idx IS NULL AS nogene FROM placed_v r LEFT JOIN sum_v s USING (rec_idx))"""


_MODE0 = _BASES + _settled("SELECT rec_idx, gene_ord FROM gf_v g WHERE hit AND f01 >= 4 AND (SELECT count(*) FROM gf_v h WHERE h.rec_idx = g.rec_idx AND h.hit) = 1", "coalesce(max(f01) FILTER (WHERE g.same), 1)")
_MODE1 = _BASES + """, each_v AS (SELECT rec_idx, i, coalesce(list(gene_ord ORDER BY gene_ord) FILTER (WHERE ex > 0), []) AS met FROM pb_v GROUP BY 1, 2),
acc_v AS (SELECT rec_idx, list_reduce(list(met ORDER BY i), lambda a, t: CASE WHEN len(a) > 0 AND len(t) > 0 THEN list_intersect(a, t) ELSE t END) AS acc FROM each_v GROUP BY 1)""" + _settled("SELECT g.rec_idx, g.gene_ord FROM gf_v g JOIN acc_v a USING (rec_idx) WHERE f01 >= 4 AND list_contains(acc, g.gene_ord)", "max(f01)")
_MODES = (_MODE0, _MODE1, _MODE2)


def _pairs(spark, sf_dir, broadcast):
    r = assign.with_places(views.reads(spark, sf_dir)).select("rec_idx", "contig", "begin", "stop")
    g = views.genes(spark, sf_dir).select("contig", "gene_ord", F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    return r, g, overlap.overlap_join(r, g, broadcast=broadcast).select("rec_idx", "gene_ord")


@query(_PAIRS + " SELECT rec_idx, gene_ord FROM pairs_v")
def overlap_join(spark, sf_dir):
    return _pairs(spark, sf_dir, True)[2]


@query(_PAIRS + " SELECT rec_idx, gene_ord FROM pairs_v")
def overlap_join_binned(spark, sf_dir):
    return _pairs(spark, sf_dir, False)[2]


@query(_PAIRS + ' SELECT rec_idx, gene_ord FROM pairs_v WHERE b <= start AND "end" <= e')
def overlap_contained(spark, sf_dir):
    r, g, _ = _pairs(spark, sf_dir, True)
    return overlap.contained_join(r, g).select("rec_idx", "gene_ord")


@query(f"""WITH {READS_SQL}, {GENES_SQL} SELECT r.rec_idx, g.gene_ord FROM reads_v r JOIN genes_v g ON r.contig = g.contig AND g.start <= r.pos + 1 AND g."end" >= r.pos + 1""")
def overlap_point(spark, sf_dir):
    _, g, _ = _pairs(spark, sf_dir, True)
    at = views.reads(spark, sf_dir).select("rec_idx", "contig", (F.col("pos") + 1).alias("at"))
    return overlap.overlap_join(at, g, "at", "at").select("rec_idx", "gene_ord")


#: Short genes far apart, so that most reads meet none.
_SPARSE = {"contig": "concat('chr', p_partkey % 3 + 1)", "gene_ord": "CAST(p_partkey AS BIGINT)", "g_start": "CAST((p_partkey * 7919) % 3000000 + 1 AS INT)", "g_end": "CAST((p_partkey * 7919) % 3000000 + 1 + p_size * 20 AS INT)"}
_NEAR = f"WITH {READS_SQL}, {_OPS}, sparse_v AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _SPARSE.items())} FROM part), near_v AS (SELECT r.rec_idx, s.gene_ord, s.g_start, s.g_end, CAST(greatest(0, s.g_start - (r.pos + l.ref_len), r.pos + 1 - s.g_end) AS INT) AS distance FROM reads_v r JOIN len_v l USING (rec_idx) JOIN sparse_v s ON s.contig = r.contig)"


def _sparse(spark, sf_dir):
    r = assign.with_places(views.reads(spark, sf_dir)).select("rec_idx", "contig", "begin", "stop")
    return r, spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*(f"{e} AS {n}" for n, e in _SPARSE.items()))


@query(_NEAR + " SELECT rec_idx, gene_ord, distance FROM near_v WHERE distance <= 700")
def overlap_near(spark, sf_dir):
    return overlap.near_by_place(*_sparse(spark, sf_dir), 700).select("rec_idx", "gene_ord", "distance")


@query(_NEAR + " SELECT rec_idx, gene_ord, g_start, g_end, distance FROM near_v WHERE distance <= 100000 QUALIFY row_number() OVER (PARTITION BY rec_idx ORDER BY distance, g_start, gene_ord) = 1")
def overlap_nearest(spark, sf_dir):
    return overlap.nearest_join(*_sparse(spark, sf_dir), 100_000, ["rec_idx"])


@query(f"""WITH {READS_SQL} SELECT rec_idx, CAST(CASE WHEN rec_idx % 4 = 0 THEN 1 ELSE greatest(1 + rec_idx % 2 * 2, 4) END AS INT) AS highest, CAST(CASE WHEN rec_idx % 4 = 0 THEN 1 ELSE 0 END AS INT) AS agreed FROM reads_v""")
def locus_combined(spark, sf_dir):
    f = F.when(F.col("rec_idx") % 4 == 0, F.array().cast("array<int>")).otherwise(F.array((1 + F.col("rec_idx") % 2 * 2).cast("int"), F.lit(4)))
    return views.reads(spark, sf_dir).select("rec_idx", locus.combined(f).cast("int").alias("highest"), locus.combined(f, conservative=True).cast("int").alias("agreed"))


@query(f'WITH {GENES_SQL} SELECT contig, min(start) AS start, max("end") AS "end" FROM genes_v GROUP BY 1')
def overlap_extents(spark, sf_dir):
    return overlap.extents(_pairs(spark, sf_dir, True)[1])


@query(_BASES + " SELECT DISTINCT rec_idx, gene_ord FROM pb_v WHERE ex > 0")
def block_exon_semi(spark, sf_dir):
    rows = assign.gene_rows(views.reads(spark, sf_dir), views.genes(spark, sf_dir), 0)
    return rows.filter(F.exists("hits", lambda h: h)).select("rec_idx", F.col("g_ord").alias("gene_ord"))


@query(_BASES + " SELECT rec_idx, gene_ord, exon, intron, CAST(f2 AS INT) AS f FROM gf_v")
def locus_counts(spark, sf_dir):
    rows = assign.gene_rows(views.reads(spark, sf_dir), views.genes(spark, sf_dir), 2)
    return rows.select("rec_idx", F.col("g_ord").alias("gene_ord"), "exon", "intron", "f")


@query(_BASES + " SELECT rec_idx, gene_ord, CAST(f01 AS INT) AS f FROM gf_v")
def locus_max(spark, sf_dir):
    rows = assign.gene_rows(views.reads(spark, sf_dir), views.genes(spark, sf_dir), 0)
    return rows.select("rec_idx", F.col("g_ord").alias("gene_ord"), "f")


def _named(spark, sf_dir):
    return filters.with_names(views.reads(spark, sf_dir))


def _assigned(mode):
    def assigned(spark, sf_dir):
        return assign.annotate(_named(spark, sf_dir), views.genes(spark, sf_dir), mode).select("rec_idx", "xf", "ge", "gs", "right", "wrong", "fixed", "rejected", "nogene")

    assigned.__name__ = f"assign_mode{mode}"
    return assigned


for _mode in (0, 1, 2):
    query(_MODES[_mode] + ' SELECT rec_idx, xf, ge, gs, "right", wrong, fixed, rejected, nogene FROM as_v')(_assigned(_mode))


def _strands(mode):
    def stranded(spark, sf_dir):
        return metrics.strand_metrics(assign.annotate(_named(spark, sf_dir), views.genes(spark, sf_dir), mode))

    stranded.__name__ = f"anno_metrics_mode{mode}"
    return stranded


for _mode in (0, 1):
    query(_MODES[_mode] + ' SELECT count(*) AS total_reads, count(*) FILTER (WHERE wrong) AS reads_wrong_strand, count(*) FILTER (WHERE "right") AS reads_right_strand, count(*) FILTER (WHERE fixed) AS read_ambiguous_gene_fixed, count(*) FILTER (WHERE rejected) AS ambiguous_reads_rejected FROM as_v')(_strands(_mode))


@query(_MODE2 + """, n_v AS (SELECT count(*) AS total_reads, count(*) FILTER (WHERE mapq >= 255) AS map, count(*) FILTER (WHERE mapq >= 255 AND xf = 'EXONIC') AS exonic, count(*) FILTER (WHERE mapq >= 255 AND xf = 'INTRONIC') AS intronic,
  count(*) FILTER (WHERE mapq >= 255 AND xf = 'INTERGENIC') + count(*) FILTER (WHERE nogene) AS intergenic, count(*) FILTER (WHERE mapq >= 255 AND xf = 'EXONIC' AND "right") AS transcriptome, count(*) FILTER (WHERE wrong) AS antisense FROM as_v)
SELECT *, """ + ", ".join(f"round(CASE WHEN total_reads = 0 THEN 0 ELSE {c} * 100.0::DOUBLE / total_reads END, 4) AS {c}_pct" for c in ("map", "exonic", "intronic", "intergenic", "transcriptome", "antisense")) + " FROM n_v")
def anno_metrics_mode2(spark, sf_dir):
    return metrics.region_metrics(assign.annotate(_named(spark, sf_dir), views.genes(spark, sf_dir), 2))


# ---- deduplication, expression, summary ---------------------------------------------------

_PASSED = _MODE2 + """, ann_v AS (SELECT *, CASE WHEN isize < 0 THEN concat(mpos - isize, mpos) ELSE concat(pos, pos + isize) END AS marker FROM as_v WHERE (hi IS NULL OR hi = 1) AND mapq >= 10 AND ge IS NOT NULL),
first_v AS (SELECT *, row_number() OVER (PARTITION BY contig, marker, cb ORDER BY rec_idx) = 1 AS one FROM ann_v)"""


def _annotated(spark, sf_dir):
    """Passed primary reads with a gene, by rule 2."""
    from ..config import Config
    from .run import annotated, prepared

    base = prepared(views.reads(spark, sf_dir), Config())
    return base, annotated(base, views.genes(spark, sf_dir), Config())


@query(_PASSED + " SELECT rec_idx, ge FROM first_v WHERE one")
def marker_dedup(spark, sf_dir):
    return dedup.by_position(settled(_annotated(spark, sf_dir)[1].filter("ge is not null"))).select("rec_idx", "ge")


@query(_PASSED + " SELECT rec_idx, CASE WHEN one THEN 'keep' ELSE 'dup' END AS status, CAST(CASE WHEN one THEN flag ELSE flag | 1024 END AS INT) AS flag FROM first_v")
def marker_dedup_flagged(spark, sf_dir):
    return dedup.by_position(settled(_annotated(spark, sf_dir)[1].filter("ge is not null")), keep=True).select("rec_idx", "status", "flag")


_EXPRESSION = _PASSED + ", exp_v AS (SELECT contig, cb AS barcode, ge AS gene, count(*) AS umi_cnt FROM first_v WHERE one GROUP BY 1, 2, 3)"


def _expression_query(spark, sf_dir):
    return counts.by_position(_annotated(spark, sf_dir)[1].filter("ge is not null"))


def _expression(spark, sf_dir):
    """The expression table as a run writes it, to be read again."""
    return settled(_expression_query(spark, sf_dir))


_QUERIES["expression"], _SQL["expression"] = _expression_query, _EXPRESSION + " SELECT contig, barcode, gene, umi_cnt FROM exp_v"


@query(_PASSED + """, n_v AS (SELECT (SELECT count(*) FROM as_v WHERE hi IS NULL OR hi = 1) AS total, (SELECT count(*) FROM as_v WHERE (hi IS NULL OR hi = 1) AND mapq >= 10) AS pass_filter, (SELECT count(*) FROM first_v) AS annotated, (SELECT count(*) FROM first_v WHERE one) AS "unique")
SELECT *, round((total - pass_filter) * 100.0::DOUBLE / total, 4) AS fail_filter_rate, round((pass_filter - annotated) * 100.0::DOUBLE / pass_filter, 4) AS fail_annotate_rate, round((annotated - "unique") * 100.0::DOUBLE / annotated, 4) AS duplication_rate FROM n_v""")
def summary_metrics(spark, sf_dir):
    from ..config import Config
    from .run import run

    return run(_records(spark, sf_dir), views.genes(spark, sf_dir), Config()).summaries["FILTER & DEDUPLICATION METRICS"]


# ---- identifiers --------------------------------------------------------------------------

_COUNTS = f"WITH {identifiers_sql(40)}, cnt_v AS (SELECT contig, barcode, gene, umi, count(*) AS cnt FROM ids_v GROUP BY 1, 2, 3, 4)"
_ROOTS = _COUNTS + """, group_v AS (SELECT contig, barcode, gene, list([{'umi': umi, 'root': umi, 'cnt': cnt}] ORDER BY cnt DESC, umi) AS l, count(*) AS n FROM cnt_v GROUP BY 1, 2, 3),
fold_v AS (SELECT contig, barcode, gene, CASE WHEN n < 5 OR gene = 'NOGENE' THEN flatten(l) ELSE list_reduce(l, lambda a, x: list_concat(a, [{'umi': x[1].umi, 'root': coalesce(list_filter(a, lambda r: r.umi = r.root AND hamming(x[1].umi, r.umi) <= 1)[1].umi, x[1].umi), 'cnt': x[1].cnt}])) END AS l FROM group_v),
flat_v AS (SELECT contig, barcode, gene, unnest(l) AS s FROM fold_v), root_v AS (SELECT contig, barcode, gene, s.umi AS umi, s.cnt AS cnt, s.root AS root_umi FROM flat_v),
roots_v AS (SELECT *, CASE WHEN umi = root_umi THEN CAST(sum(cnt) OVER (PARTITION BY contig, barcode, gene, root_umi) AS BIGINT) ELSE 0 END AS cluster_cnt FROM root_v)"""


def _ids(spark, sf_dir):
    r = views.identifiers(spark, sf_dir, 40)
    return r.select(F.lit(0).alias("file_idx"), F.col("event_id").alias("rec_idx"), "contig", F.col("barcode").alias("cb"), F.when(F.col("gene") != "NOGENE", F.col("gene")).alias("ge"), F.col("umi").alias("ur"), F.lit(0).alias("flag"))


def _roots(spark, sf_dir, fold=dedup.FOLD):
    return dedup.correct_identifiers(dedup.identifier_counts(_ids(spark, sf_dir)), 5, 1, fold)


@query(f"WITH {identifiers_sql(40)} SELECT event_id AS rec_idx FROM ids_v WHERE gene <> 'NOGENE' QUALIFY row_number() OVER (PARTITION BY contig, barcode, gene, umi ORDER BY event_id) = 1")
def umi_first_dedup(spark, sf_dir):
    return dedup.by_identifier(_ids(spark, sf_dir).filter("ge is not null")).select("rec_idx")


@query(_COUNTS + " SELECT * FROM cnt_v")
def umi_counts(spark, sf_dir):
    return dedup.identifier_counts(_ids(spark, sf_dir))


@query(_COUNTS + " SELECT a.barcode, a.gene, a.umi AS umi_a, b.umi AS umi_b, CAST(hamming(a.umi, b.umi) AS INT) AS distance FROM cnt_v a JOIN cnt_v b ON a.contig = b.contig AND a.barcode = b.barcode AND a.gene = b.gene AND a.umi < b.umi WHERE hamming(a.umi, b.umi) <= 1")
def umi_distance_pairs(spark, sf_dir):
    c = dedup.identifier_counts(_ids(spark, sf_dir)).select(F.concat_ws("|", "contig", "barcode", "gene").alias("group"), "barcode", "gene", "umi")
    c = settled(ranking.placed(c, ["umi", "group"], "id"))
    name = lambda k, at: c.select(F.col("id").alias(k), F.col("umi").alias(at))
    pairs = identifiers.near_pairs(c, 1, name="umi").join(c.select(F.col("id").alias("x"), "barcode", "gene", F.col("umi").alias("umi_b")), "x").join(name("r", "umi_a"), "r")
    return pairs.select("barcode", "gene", "umi_a", "umi_b", names.hamming(F.col("umi_a"), F.col("umi_b")).alias("distance"))


@query(_ROOTS + " SELECT contig, barcode, gene, umi, cnt, root_umi, cluster_cnt FROM roots_v")
def umi_correct(spark, sf_dir):
    return _roots(spark, sf_dir)


@query(_ROOTS + " SELECT contig, barcode, gene, umi, cnt, root_umi, cluster_cnt FROM roots_v")
def umi_correct_large(spark, sf_dir):
    """As umi_correct, all groups by the way of large ones."""
    return _roots(spark, sf_dir, fold=0)


@query(_ROOTS + " SELECT contig, barcode, gene, count(*) AS umi_cnt, CAST(sum(cluster_cnt) AS BIGINT) AS read_cnt FROM roots_v WHERE gene <> 'NOGENE' AND umi = root_umi GROUP BY 1, 2, 3")
def umi_expression(spark, sf_dir):
    return counts.by_identifier(_roots(spark, sf_dir))


@query(_ROOTS + """, fd_v AS (SELECT event_id, contig, barcode, gene, umi FROM ids_v WHERE gene <> 'NOGENE' QUALIFY row_number() OVER (PARTITION BY contig, barcode, gene, umi ORDER BY event_id) = 1)
SELECT event_id AS rec_idx, CASE WHEN umi = root_umi THEN 'keep' ELSE 'collapsed' END AS status, CASE WHEN umi <> root_umi THEN root_umi END AS ub, CAST(CASE WHEN umi = root_umi THEN 0 ELSE 1024 END AS INT) AS flag FROM fd_v JOIN roots_v USING (contig, barcode, gene, umi)""")
def umi_second_dedup(spark, sf_dir):
    first = dedup.by_identifier(_ids(spark, sf_dir).filter("ge is not null"))
    return dedup.by_corrected(first, _roots(spark, sf_dir), keep=True).select("rec_idx", "status", "ub", "flag")


@query(_ROOTS + """, n_v AS (SELECT count(DISTINCT (contig, barcode, gene)) AS barcode_gene_num, count(*) AS umi_cnt_raw, count(*) FILTER (WHERE umi = root_umi) AS umi_cnt_dedup FROM roots_v)
SELECT *, round(umi_cnt_raw * 100.0::DOUBLE / barcode_gene_num, 4) AS raw_pct, round(umi_cnt_dedup * 100.0::DOUBLE / barcode_gene_num, 4) AS dedup_pct FROM n_v""")
def umi_totals(spark, sf_dir):
    return metrics.identifier_totals(_roots(spark, sf_dir))


_DIFF = _ROOTS + ", diff_v AS (SELECT p AS position, substr(umi, p, 1) AS a, substr(root_umi, p, 1) AS b FROM (SELECT umi, root_umi, unnest(range(1, length(umi) + 1)) AS p FROM roots_v WHERE umi <> root_umi) WHERE substr(umi, p, 1) <> substr(root_umi, p, 1))"
_SHARE = "round(CASE WHEN (SELECT count(*) FROM diff_v) = 0 THEN 0 ELSE count(d.position) * 100.0::DOUBLE / (SELECT count(*) FROM diff_v) END, 4) AS pct"


@query(_DIFF + f" SELECT CAST(s.p AS INT) AS position, count(d.position) AS cnt, {_SHARE} FROM (SELECT unnest(range(1, 7)) AS p) s LEFT JOIN diff_v d ON d.position = s.p GROUP BY 1")
def umi_mismatch_pos(spark, sf_dir):
    return metrics.mismatch_positions(_roots(spark, sf_dir), 6)


@query(_DIFF + f" SELECT concat(x.a, '_', y.b) AS type, count(d.position) AS cnt, {_SHARE} FROM (SELECT unnest(['A','C','T','G']) AS a) x CROSS JOIN (SELECT unnest(['A','C','T','G']) AS b) y LEFT JOIN diff_v d ON d.a = x.a AND d.b = y.b GROUP BY 1")
def umi_mismatch_type(spark, sf_dir):
    return metrics.mismatch_types(_roots(spark, sf_dir))


# ---- saturation ---------------------------------------------------------------------------

_LEVELS = "[" + ", ".join(f"{x}::DOUBLE" for x in saturation.LEVELS) + "]"
_ORDERED = f"WITH {READS_SQL}, sat_v AS (SELECT cb AS barcode, CASE WHEN rec_idx % 9 = 0 THEN 'NOGENE' ELSE concat('G', rec_idx % 13) END AS gene, ur AS umi, row_number() OVER (ORDER BY (rec_idx * 7919) % 1000003, rec_idx) AS rn FROM named_v), lev_v AS (SELECT unnest({_LEVELS}) AS sample), smp_v AS (SELECT sample, barcode, gene, umi FROM sat_v JOIN lev_v ON rn <= floor(sample * (SELECT count(*) FROM sat_v)))"


def _curve_sql(unit: str, x: str, y1: str, y2: str) -> str:
    return f"""SELECT s.sample, CAST(s.reads // s.units AS BIGINT) AS {x}, round(1 - CASE WHEN s.sat = 0 THEN NULL ELSE s.uniq::DOUBLE / s.sat END, 6) AS {y1}, s.v[CAST(s.units // 2 AS INT) + 1] AS {y2} FROM (
  SELECT sample, count(*) AS units, sum(reads) AS reads, sum(sat) AS sat, sum(uniq) AS uniq, list(genes ORDER BY genes) AS v FROM (
    SELECT sample, {unit} AS unit, count(*) AS reads, count(*) FILTER (WHERE gene <> 'NOGENE') AS sat, count(DISTINCT concat(gene, '|', umi)) FILTER (WHERE gene <> 'NOGENE') AS uniq, count(DISTINCT gene) FILTER (WHERE gene <> 'NOGENE') AS genes FROM smp_v GROUP BY 1, 2) GROUP BY 1) s"""


def _ordered(spark, sf_dir):
    r = _named(spark, sf_dir).select(F.col("cb").alias("barcode"), F.when(F.col("rec_idx") % 9 == 0, "NOGENE").otherwise(F.concat(F.lit("G"), (F.col("rec_idx") % 13).cast("string"))).alias("gene"), F.col("ur").alias("umi"), ((F.col("rec_idx") * 7919) % 1000003).alias("_key"), F.col("rec_idx").alias("k"))
    place = F.shiftleft(F.col("_key"), 40)
    return saturation.first_seen(saturation.leveled(r.select("k", "barcode", "gene", "umi", "_key"), place))


@query(_ORDERED + " " + _curve_sql("barcode", "bar_x", "bar_y1", "bar_y2"))
def saturation_barcode(spark, sf_dir):
    return saturation.curve(_ordered(spark, sf_dir), "barcode", "bar_x", "bar_y1", "bar_y2")


_BIN_OF = "concat(CAST(split_part(barcode, '_', 3) AS INT) // 150, '_', CAST(split_part(barcode, '_', 4) AS INT) // 150)"


@query(_ORDERED + " " + _curve_sql(_BIN_OF, "bin_x", "bin_y1", "bin_y2"))
def saturation_bin(spark, sf_dir):
    seen = _ordered(spark, sf_dir).withColumn("bin", saturation.spatial_bin(F.col("barcode")))
    return saturation.curve(saturation.first_seen(seen, "bin"), "bin", "bin_x", "bin_y1", "bin_y2")


# ---- matrix and density -------------------------------------------------------------------

_TOTALS = _EXPRESSION + ", sum_v AS (SELECT barcode, gene, CAST(sum(umi_cnt) AS BIGINT) AS umi_cnt FROM exp_v GROUP BY 1, 2), tot_v AS (SELECT barcode, CAST(sum(umi_cnt) AS BIGINT) AS total FROM exp_v GROUP BY 1)"
_INDEX = _TOTALS + ", kept_v AS (SELECT s.* FROM sum_v s JOIN tot_v t USING (barcode) WHERE t.total >= 3), i_v AS (SELECT barcode, CAST(row_number() OVER (ORDER BY barcode) AS INT) AS i FROM (SELECT DISTINCT barcode FROM kept_v)), j_v AS (SELECT gene, CAST(row_number() OVER (ORDER BY gene) AS INT) AS j FROM (SELECT DISTINCT gene FROM kept_v))"


@query(_TOTALS + " SELECT * FROM sum_v")
def matrix_sum(spark, sf_dir):
    return counts.across_contigs(_expression(spark, sf_dir))


@query(_TOTALS + " SELECT * FROM tot_v")
def barcode_totals(spark, sf_dir):
    return counts.barcode_totals(_expression(spark, sf_dir))


@query(_TOTALS + " SELECT e.contig, e.barcode, e.gene, e.umi_cnt FROM exp_v e JOIN tot_v t USING (barcode) WHERE t.total >= 3")
def barcode_filter(spark, sf_dir):
    return matrix.filtered(_expression(spark, sf_dir), 3).select("contig", "barcode", "gene", "umi_cnt")


@query(_INDEX + " SELECT 'barcode' AS kind, barcode AS name, i AS place FROM i_v UNION ALL SELECT 'gene', gene, j FROM j_v")
def matrix_index(spark, sf_dir):
    _, rows, cols = matrix.triplets(matrix.filtered(_expression(spark, sf_dir), 3))
    return rows.select(F.lit("barcode").alias("kind"), F.col("barcode").alias("name"), F.col("i").alias("place")).unionByName(cols.select(F.lit("gene").alias("kind"), F.col("gene").alias("name"), F.col("j").alias("place")))


@query(_INDEX + " SELECT i, j, umi_cnt AS cnt FROM kept_v JOIN i_v USING (barcode) JOIN j_v USING (gene)")
def matrix_triplets(spark, sf_dir):
    return matrix.triplets(matrix.filtered(_expression(spark, sf_dir), 3))[0]


@query(_TOTALS + ", h_v AS (SELECT total, count(*) AS n FROM tot_v GROUP BY 1) SELECT CASE WHEN max(n) > 1 THEN (SELECT max(total) FROM h_v WHERE n = (SELECT max(n) FROM h_v)) ELSE min(total) END AS value FROM h_v")
def barcode_mode(spark, sf_dir):
    return density.mode(density.histogram(counts.barcode_totals(_expression(spark, sf_dir))))


_SUPPLIED = "SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY 1"


def _supplied(spark, sf_dir):
    """The quantities that suppliers have delivered, in sum."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("total"))


@query(f"""WITH h_v AS (SELECT total, count(*) AS n FROM ({_SUPPLIED}) GROUP BY 1), m_v AS (SELECT CASE WHEN max(n) > 1 THEN (SELECT max(total) FROM h_v WHERE n = (SELECT max(n) FROM h_v)) ELSE min(total) END AS value FROM h_v),
k_v AS (SELECT total, n FROM h_v, m_v WHERE total > value - 3), g_v AS (SELECT log10(min(total)) - 0.4 AS low, (log10(max(total)) - log10(min(total)) + 0.8) / 16383 AS step, sum(n) AS n FROM k_v),
a_v AS (SELECT (log10(total) - g_v.low) / g_v.step AS place, k_v.n / g_v.n AS w FROM k_v, g_v), c_v AS (SELECT CAST(floor(place) AS INT) AS cell, place - floor(place) AS part, w FROM a_v)
SELECT cell, round(sum(mass), 9) AS mass FROM (SELECT cell, w * (1 - part) AS mass FROM c_v UNION ALL SELECT cell + 1, w * part FROM c_v) GROUP BY 1""")
def kde_cells(spark, sf_dir):
    return density.cells(_supplied(spark, sf_dir))[0].select("cell", F.round("mass", 9).alias("mass"))


@query()
def kde_threshold(spark, sf_dir):
    """The density threshold of what suppliers have delivered."""
    return spark.createDataFrame([(density.barcode_threshold(_supplied(spark, sf_dir)),)], "threshold double")


# ---- whole runs, and files read back ---------------------------------------------------------

_RUN = _MODE2 + """, base_v AS (SELECT * FROM as_v WHERE hi IS NULL OR hi = 1),
cnt_v AS (SELECT contig, cb AS barcode, CASE WHEN mapq >= 10 THEN coalesce(ge, 'NOGENE') ELSE 'NOGENE' END AS gene, ur AS umi, count(*) AS cnt FROM base_v GROUP BY 1, 2, 3, 4)""" + _ROOTS[len(_COUNTS):] + """,
one_v AS (SELECT *, row_number() OVER (PARTITION BY contig, cb, ge, ur ORDER BY rec_idx) = 1 AS one FROM base_v WHERE mapq >= 10 AND ge IS NOT NULL)
SELECT rec_idx, flag | 512 AS flag, 'lowq' AS status, CAST(NULL AS VARCHAR) AS xf, CAST(NULL AS VARCHAR) AS ge, CAST(NULL AS VARCHAR) AS ub FROM base_v WHERE mapq < 10
UNION ALL SELECT rec_idx, flag, 'keep', xf, NULL, NULL FROM base_v WHERE mapq >= 10 AND ge IS NULL
UNION ALL SELECT rec_idx, CASE WHEN one AND ur = root_umi THEN flag ELSE flag | 1024 END, CASE WHEN NOT one THEN 'dup' WHEN ur = root_umi THEN 'keep' ELSE 'collapsed' END, xf, ge, CASE WHEN one AND ur <> root_umi THEN root_umi END FROM one_v o JOIN roots_v r ON r.contig = o.contig AND r.barcode = o.cb AND r.gene = o.ge AND r.umi = o.ur"""


@query(_RUN)
def full_run(spark, sf_dir):
    """The output rows of a run that keeps and flags what it would drop."""
    from ..config import Config
    from .run import run

    return run(_records(spark, sf_dir), views.genes(spark, sf_dir), Config(keep_low_quality=True, keep_duplicates=True, umi=True)).reads.select("rec_idx", "flag", "status", "xf", "ge", "ub")


def _records(spark, sf_dir):
    """The reads with bases, qualities and tags."""
    return views.reads(spark, sf_dir).withColumns({"seq": F.lit("*"), "qual": F.lit("*"), "tags": F.create_map(F.lit("XR"), F.col("rec_idx").cast("string"))})


_CONTIGS = [("chr1", 80_000), ("chr2", 80_000), ("chr3", 80_000)]


def _bam(spark, sf_dir):
    """The reads as files sorted by place, one a task."""
    bam.register(spark)
    folder = new_folder(spark, "bam")
    rows = _records(spark, sf_dir).repartitionByRange("contig", "pos").sortWithinPartitions("contig", "pos")
    rows.write.format("bam").mode("append").option("contigs", ",".join(f"{c}:{n}" for c, n in _CONTIGS)).option("sorted", "true").save(folder)
    files = bam.files(folder)
    return files, spark.read.format("bam").option("splitBytes", str(256 << 10)).load(files)


@query(f"WITH {READS_SQL} SELECT rec_idx, qname, flag, contig, pos, mapq, cigar, mpos, isize, hi FROM reads_v")
def bam_read_back(spark, sf_dir):
    read = _bam(spark, sf_dir)[1].withColumn("rec_idx", F.try_element_at("tags", F.lit("XR")).cast("bigint"))
    return read.select("rec_idx", "qname", "flag", "contig", "pos", "mapq", "cigar", "mpos", "isize", "hi")


@query(f"WITH {READS_SQL}, {_OPS} SELECT r.qname FROM reads_v r JOIN len_v USING (rec_idx) WHERE contig = 'chr2' AND pos < 31000 AND pos + ref_len > 30000")
def bam_range_scan(spark, sf_dir):
    """No read is longer than 1,100 places, so the range bounds positions on both sides."""
    length = cigar.reference_length(cigar.operations(F.col("cigar")))
    return filters.in_range(_bam(spark, sf_dir)[1], "chr2", 30_000, 31_000, length, longest=1100).select("qname")


@query(f"WITH {READS_SQL} SELECT CAST(right(contig, 1) AS INT) - 1 AS contig_idx, contig, CAST(80000 AS BIGINT) AS length, count(*) AS n FROM reads_v GROUP BY 2")
def bam_contigs(spark, sf_dir):
    """The contigs of files' headers, with the reads on each."""
    files, read = _bam(spark, sf_dir)
    return bam.contigs(spark, files).join(read.groupBy("contig").agg(F.count(F.lit(1)).alias("n")), "contig").select("contig_idx", "contig", "length", "n")


@query(_EXPRESSION + " SELECT barcode, gene, umi_cnt FROM exp_v")
def expression_file(spark, sf_dir):
    folder = new_folder(spark, "expression")
    sinks.write_expression(_expression_query(spark, sf_dir), folder)
    return sinks.read_expression(spark, folder)


@query(_INDEX + """, t_v AS (SELECT i, j, umi_cnt AS cnt FROM kept_v JOIN i_v USING (barcode) JOIN j_v USING (gene))
SELECT 'matrix' AS file, concat_ws(' ', i, j, cnt) AS line FROM t_v UNION ALL SELECT 'matrix', unnest(['%%MatrixMarket matrix coordinate real general', '%', concat_ws(' ', (SELECT count(*) FROM i_v), (SELECT count(*) FROM j_v), (SELECT count(*) FROM t_v))])
UNION ALL SELECT 'barcodes', barcode FROM i_v UNION ALL SELECT 'genes', gene FROM j_v""")
def matrix_files(spark, sf_dir):
    folder = new_folder(spark, "matrix")
    sinks.write_matrix(*matrix.triplets(matrix.filtered(_expression(spark, sf_dir), 3)), folder)
    read = lambda file, name: spark.read.text(f"{folder}/{name}").select(F.lit(file).alias("file"), F.col("value").alias("line"))
    return read("matrix", "matrix.mtx").unionByName(read("barcodes", "barcodes.tsv")).unionByName(read("genes", "genes.tsv"))


@query(_ORDERED + " " + _curve_sql("barcode", "bar_x", "bar_y1", "bar_y2"))
def saturation_file(spark, sf_dir):
    folder = new_folder(spark, "saturation")
    sinks.write_saturation(saturation.curve(_ordered(spark, sf_dir), "barcode", "bar_x", "bar_y1", "bar_y2"), folder)
    return spark.read.schema("sample double, bar_x bigint, bar_y1 double, bar_y2 bigint").csv(folder, sep=" ", header=True)


_COUNTED = f"sat_v AS (SELECT cb AS barcode, CASE WHEN rec_idx % 9 = 0 THEN 'NOGENE' ELSE concat('G', rec_idx % 13) END AS gene, ur AS umi, CAST(max(rec_idx % 4) AS BIGINT) AS cnt FROM named_v GROUP BY 1, 2, 3)"


@query(f"WITH {READS_SQL}, {_COUNTED}, smp_v AS (SELECT 1.0::DOUBLE AS sample, barcode, gene, umi FROM (SELECT *, unnest(range(cnt)) FROM sat_v)) SELECT * FROM ({_curve_sql('barcode', 'bar_x', 'bar_y1', 'bar_y2')}) JOIN ({_curve_sql(_BIN_OF, 'bin_x', 'bin_y1', 'bin_y2')}) USING (sample)")
def saturation_whole(spark, sf_dir):
    """The last level of reads in random order, which has them all; identifiers of no reads do not count."""
    r = _named(spark, sf_dir).select(F.col("cb").alias("barcode"), F.when(F.col("rec_idx") % 9 == 0, "NOGENE").otherwise(F.concat(F.lit("G"), (F.col("rec_idx") % 13).cast("string"))).alias("gene"), F.col("ur").alias("umi"), (F.col("rec_idx") % 4).alias("cnt"))
    table = r.groupBy("barcode", "gene", "umi").agg(F.max("cnt").alias("cnt"))
    return saturation.saturation(table, coordinates=True).filter("sample = 1")


_HEAD = ("total", "pass_filter", "annotated", "unique", "fail_filter_rate", "fail_annotate_rate", "duplication_rate")
_VALUES = ", ".join(f"printf('%.2f', {c})" if c.endswith("_rate") else f'"{c}"' for c in _HEAD)


@query(f"""WITH {_SQL["summary_metrics"][5:].replace("SELECT *, round(", ", m_v AS (SELECT *, round(", 1)}) SELECT unnest(['## FILTER & DEDUPLICATION METRICS', '{chr(9).join(_HEAD).upper()}', concat_ws(chr(9), {_VALUES})]) AS line FROM m_v""")
def summary_lines(spark, sf_dir):
    text = sinks.summary_text({"FILTER & DEDUPLICATION METRICS": summary_metrics(spark, sf_dir)})
    return spark.createDataFrame([(line,) for line in text.splitlines()], "line string")
