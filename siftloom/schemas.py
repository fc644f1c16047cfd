"""Schemas of reads, contigs, annotation lines and the gene model."""

from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, LongType, MapType, StringType, StructField, StructType

INT, LONG, STRING, BOOLEAN = IntegerType(), LongType(), StringType(), BooleanType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


READS = _table(
    file_idx=INT, rec_idx=LONG, qname=STRING, flag=INT, contig=STRING, pos=INT, mapq=INT, cigar=STRING,
    mpos=INT, isize=INT, seq=STRING, qual=STRING, hi=INT, tags=MapType(STRING, STRING),
)
CONTIGS = _table(contig_idx=INT, contig=STRING, length=LONG)
EXON = _table(start=INT, end=INT)
TRANSCRIPT = _table(transcript_key=STRING, tx_start=INT, tx_end=INT, cds_start=INT, cds_end=INT, exons=ArrayType(EXON))
GENES = _table(gene_ord=LONG, contig=STRING, gene_name=STRING, gene_id=STRING, start=INT, end=INT, neg_strand=BOOLEAN, transcripts=ArrayType(TRANSCRIPT))
#: Where a read comes from; the pair orders the whole input.
READ_ID = ["file_idx", "rec_idx"]

# Bits of the alignment flag, and the parts of a read name that carry tags.
REVERSE, QC_FAIL, DUPLICATE = 0x10, 0x200, 0x400
NAME_SEPARATOR, NO_GENE = "|||", "NOGENE"
#: Contigs that are left out, by exact name.
EXCLUDED_CONTIGS = ("chrGL", "chrNC", "chrhs", "random", "chrU", "chrEK", "chrAQ")
#: Locus functions in ascending rank; a higher one wins.
LOCUS = {0: "NONE", 1: "INTERGENIC", 2: "RIBOSOMAL", 3: "INTRONIC", 4: "UTR", 5: "EXONIC"}
NONE, INTERGENIC, INTRONIC, UTR, CODING = 0, 1, 3, 4, 5
