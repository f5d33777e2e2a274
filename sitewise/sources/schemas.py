"""Fixed schemas of the files that jobs read; none is inferred."""

from pyspark.sql import types as T


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind(), True) for name, kind in columns.items()])


S, L, I = T.StringType, T.LongType, T.IntegerType  # noqa: E741

READ = _schema(name=S, seq=S, qual=S)
STRAND_UMI = _schema(chrom=S, pos=L, seq=S, qual=S)
GROUPED_UMI = _schema(chrom=S, pos=L, seqs=S, quals=S)
DEDUP_UMI = _schema(chrom=S, pos=L, seqs=S, counts=I)
CUT_SITE = _schema(chrom=S, start=L, stop=L, name=S)
SNP = _schema(chrom=S, snp_pos=L, ref=S, alt=S)
BED5 = _schema(chrom=S, start=L, stop=L, name=S, score=L)
SAM = ("qname", "flag", "chrom", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
SAM_INTS = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}
