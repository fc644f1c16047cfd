"""Reads and genes derived from the test tables, as expressions that Spark and DuckDB share.

`//` is DuckDB's integer division; for Spark it is written `div`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READS = {
    "file_idx": "CAST(0 AS INT)",
    "rec_idx": "event_id",
    "qname": "concat('E', event_id, '|||CB:Z:41_16_', (user_id * 7) % 400, '_', (user_id * 13) % 400, '|||UR:Z:', translate(concat(((event_id*31)//64) % 4, ((event_id*31)//16) % 4, ((event_id*31)//4) % 4, (event_id*31) % 4), '0123', 'ACGT'))",
    "flag": "CAST(CASE WHEN user_id % 2 = 0 THEN 0 ELSE 16 END AS INT)",
    "contig": "concat('chr', event_id % 3 + 1)",
    "pos": "CAST((event_id * 37) % 80000 AS INT)",
    "mapq": "CAST(CASE WHEN event_id % 10 = 0 THEN 3 WHEN event_id % 4 = 0 THEN 255 ELSE 60 END AS INT)",
    "cigar": "CASE event_id % 5 WHEN 0 THEN '100M' WHEN 1 THEN '50M200N50M' WHEN 2 THEN '10S90M' WHEN 3 THEN '40M5I20M2D35M' ELSE '30M1000N70M' END",
    "mpos": "CAST((event_id * 17) % 300 AS INT)",
    "isize": "CAST(CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 200 ELSE -150 END AS INT)",
    "hi": "CAST(CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS INT)",
}
#: Groups of many identifiers of six bases.
IDENTIFIERS = {
    "contig": "'chr1'",
    "barcode": "concat('B', user_id % 5)",
    "gene": "CASE WHEN event_id % {genes} = 3 THEN 'NOGENE' ELSE concat('G', event_id % {genes}) END",
    "umi": "translate(concat((event_id*event_id//7) % 4, (event_id//3) % 4, (event_id//5) % 4, (event_id*3//11) % 4, (event_id//13) % 4, (event_id//17) % 4), '0123', 'ACGT')",
}
GENES = {
    "gene_ord": "CAST(p_partkey AS BIGINT)",
    "contig": "concat('chr', p_partkey % 3 + 1)",
    "gene_name": "concat('G', p_partkey)",
    "start": "CAST((p_partkey//3)*120 + 1 AS INT)",
    "end": "CAST((p_partkey//3)*120 + 400 AS INT)",
    "neg_strand": "p_size % 2 = 1",
    "e1_start": "CAST((p_partkey//3)*120 + 1 AS INT)",
    "e1_end": "CAST((p_partkey//3)*120 + 150 AS INT)",
    "e2_start": "CAST((p_partkey//3)*120 + 251 AS INT)",
    "e2_end": "CAST((p_partkey//3)*120 + 400 AS INT)",
    "cds_start": "CAST((p_partkey//3)*120 + 51 AS INT)",
    "cds_end": "CAST((p_partkey//3)*120 + 350 AS INT)",
}
#: Annotation lines: several genes share a name, some on several contigs; some break a rule.
LINES = [
    ("gene", "start", "\"end\" + CASE WHEN p_partkey % 41 = 0 THEN 5 ELSE 0 END", ""),
    ("transcript", "start", "\"end\"", "tx"),
    ("exon", "e1_start", "e1_end", "tx"),
    ("exon", "e2_start - CASE WHEN p_partkey % 43 = 0 THEN 120 ELSE 0 END", "e2_end", "CASE"),
    ("CDS", "cds_start", "cds_end", "tx"),
]


def _dialect(sql: str) -> str:
    return sql.replace("//", " div ").replace('"end"', "`end`")


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{_dialect(e)} AS `{n}`" for n, e in columns.items()]


def _sql(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {source}"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*_select(READS))


def flat_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*_select(GENES))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = flat_genes(spark, sf_dir)
    exon = lambda k: F.struct(F.col(f"e{k}_start").alias("start"), F.col(f"e{k}_end").alias("end"))
    t = F.struct(F.lit("T").alias("transcript_key"), F.col("start").alias("tx_start"), F.col("end").alias("tx_end"), "cds_start", "cds_end", F.array(exon(1), exon(2)).alias("exons"))
    return g.select("gene_ord", "contig", "gene_name", F.col("gene_name").alias("gene_id"), "start", "end", "neg_strand", F.array(t).alias("transcripts"))


def identifiers(spark: SparkSession, sf_dir: str, n_genes: int = 4) -> DataFrame:
    cols = {n: e.format(genes=n_genes) for n, e in IDENTIFIERS.items()}
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", *_select(cols))


def _line_columns() -> list[dict[str, str]]:
    out = []
    for k, (feature, start, end, tx) in enumerate(LINES):
        tid = {"": "''", "tx": "concat('T', p_partkey)", "CASE": "CASE WHEN p_partkey % 47 = 0 THEN '' ELSE concat('T', p_partkey) END"}[tx]
        attributes = f"concat('gene_id \"E', CASE WHEN p_partkey % 37 = 0 AND {k} = 1 THEN 9999 ELSE p_partkey % 500 END, '\"; gene_name \"N', p_partkey % 500, '\"', CASE WHEN {tid} = '' THEN '' ELSE concat('; transcript_id \"', {tid}, '\"') END, ';')"
        out.append({"line_no": f"CAST(p_partkey AS BIGINT) * 10 + {k}", "contig": "contig", "feature": f"'{feature}'", "start": f"CAST({start} AS INT)", "end": f"CAST({end} AS INT)", "strand": "CASE WHEN neg_strand THEN '-' ELSE '+' END", "attributes": attributes})
    return out


_CONTIG = "concat('chr', CASE WHEN p_partkey % 500 < 400 THEN p_partkey % 500 % 3 + 1 ELSE p_partkey % 3 + 1 END)"


def gtf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_no, value: the text of an annotation file."""
    base = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey", *_select(GENES | {"contig": _CONTIG}))
    out = None
    for cols in _line_columns():
        value = _dialect("concat({contig}, '\\tx\\t', {feature}, '\\t', {start}, '\\t', {end}, '\\t.\\t', {strand}, '\\t.\\t', {attributes})".format(**cols))
        part = base.selectExpr(f"{cols['line_no']} AS line_no", f"{value} AS value")
        out = part if out is None else out.unionByName(part)
    return out


READS_SQL = f"reads_v AS ({_sql(READS, 'events')}), named_v AS (SELECT *, split_part(split_part(qname, '|||CB:Z:', 2), '|||', 1) AS cb, split_part(qname, '|||UR:Z:', 2) AS ur FROM reads_v)"
GENES_SQL = f"genes_v AS ({_sql(GENES, 'part')})"
LINES_SQL = (
    f"annotated_v AS (SELECT p_partkey, {_sql(GENES | {'contig': _CONTIG}, 'part')[7:]}), raw_v AS ("
    + " UNION ALL ".join(_sql(c, "annotated_v") for c in _line_columns())
    + """), lines_v AS (SELECT line_no, contig, feature, start, "end", strand, regexp_extract(attributes, 'gene_id "([^"]*)"', 1) AS gene_id, regexp_extract(attributes, 'gene_name "([^"]*)"', 1) AS gene_name, regexp_extract(attributes, 'transcript_id "([^"]*)"', 1) AS transcript_id FROM raw_v)"""
)


def identifiers_sql(n_genes: int = 4) -> str:
    cols = {"event_id": "event_id"} | {n: e.format(genes=n_genes) for n, e in IDENTIFIERS.items()}
    return f"ids_v AS ({_sql(cols, 'events')})"
