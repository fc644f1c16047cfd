"""What a run writes: expression and saturation tables, summaries, the sparse matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPRESSION = "barcode STRING, gene STRING, umi_cnt BIGINT"


def write_expression(expression: DataFrame, path: str, reads: bool = False) -> None:
    """A folder of tab-separated files without a header, by contig, barcode and gene."""
    cols = ["barcode", "gene", "umi_cnt", *(["read_cnt"] if reads else [])]
    expression.orderBy("contig", "barcode", "gene").select(*cols).write.mode("overwrite").csv(path, sep="\t")


def read_expression(spark: SparkSession, path: str, reads: bool = False) -> DataFrame:
    return spark.read.schema(EXPRESSION + (", read_cnt BIGINT" if reads else "")).csv(path, sep="\t")


def write_saturation(curve: DataFrame, path: str) -> None:
    """One file: a header, then space-separated rows by sample. A curve has eleven rows."""
    names = curve.columns
    head = curve.sparkSession.createDataFrame([(-1.0, " ".join(names))], "sample double, value string")
    rows = curve.select("sample", F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names)).alias("value"))
    head.unionByName(rows).coalesce(1).sortWithinPartitions("sample").select("value").write.mode("overwrite").text(path)


def summary_text(sections: dict[str, DataFrame]) -> str:
    """Sections of small tables, tab-separated under `## name` and a header."""
    out = []
    for name, df in sections.items():
        out += [f"## {name}", "\t".join(df.columns).upper()]
        out += ["\t".join(f"{v:.2f}" if isinstance(v, float) else str(v) for v in row) for row in df.collect()]
    return "\n".join(out) + "\n"


def write_matrix(triplets: DataFrame, barcodes: DataFrame, genes: DataFrame, path: str) -> None:
    """Folders barcodes.tsv, genes.tsv and matrix.mtx of gzipped text, in the order of their indices.
    The header is the first file's first lines."""
    for df, name, key in ((barcodes, "barcode", "i"), (genes, "gene", "j")):
        df.orderBy(key).select(name).write.mode("overwrite").text(f"{path}/{name}s.tsv", compression="gzip")
    sizes = [df.count() for df in (barcodes, genes, triplets)]
    head = f"%%MatrixMarket matrix coordinate real general\n%\n{sizes[0]} {sizes[1]} {sizes[2]}"
    lines = triplets.select("i", "j", F.concat_ws(" ", "i", "j", "cnt").alias("value"))
    first = triplets.sparkSession.createDataFrame([(0, 0, head)], lines.schema)
    first.unionByName(lines).orderBy("i", "j").select("value").write.mode("overwrite").text(f"{path}/matrix.mtx", compression="gzip")
