"""Variant records from API pages, reshaped to the column layout of the mutation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a mutation file, in file order.
MAF_COLUMNS = [
    "Hugo_Symbol", "Entrez_Gene_Id", "Center", "NCBI_Build", "Chromosome", "Start_Position", "End_Position", "Strand",
    "Consequence", "Variant_Classification", "Variant_Type", "Reference_Allele", "Tumor_Seq_Allele1",
    "Tumor_Seq_Allele2", "dbSNP_RS", "dbSNP_Val_Status", "Tumor_Sample_Barcode", "Matched_Norm_Sample_Barcode",
    "Match_Norm_Seq_Allele1", "Match_Norm_Seq_Allele2", "Tumor_Validation_Allele1", "Tumor_Validation_Allele2",
    "Match_Norm_Validation_Allele1", "Match_Norm_Validation_Allele2", "Verification_Status", "Validation_Status",
    "Mutation_Status", "Sequencing_Phase", "Sequence_Source", "Validation_Method", "Score", "BAM_File", "Sequencer",
    "t_ref_count", "t_alt_count", "n_ref_count", "n_alt_count", "HGVSc", "HGVSp", "HGVSp_Short", "Transcript_ID",
    "RefSeq", "Protein_position", "Codons", "Hotspot",
]
# Mutation file column -> field of an API record.
RECORD_FIELDS = {
    "Entrez_Gene_Id": "entrezGeneId",
    "Center": "center",
    "NCBI_Build": "ncbiBuild",
    "Chromosome": "chr",
    "Start_Position": "startPosition",
    "End_Position": "endPosition",
    "Variant_Classification": "mutationType",
    "Variant_Type": "variantType",
    "Reference_Allele": "referenceAllele",
    "Tumor_Seq_Allele2": "variantAllele",
    "Tumor_Sample_Barcode": "sampleId",
    "Validation_Status": "validationStatus",
    "Mutation_Status": "mutationStatus",
    "t_ref_count": "tumorRefCount",
    "t_alt_count": "tumorAltCount",
    "n_ref_count": "normalRefCount",
    "n_alt_count": "normalAltCount",
    "HGVSp_Short": "proteinChange",
    "RefSeq": "refseqMrnaId",
    "Protein_position": "proteinPosStart",
}
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("gene", T.StructType([T.StructField("hugoGeneSymbol", T.StringType())])),
        *[T.StructField(name, T.StringType()) for name in RECORD_FIELDS.values()],
    ]
)


def read_mutation_pages(spark: SparkSession, path: str, page_per_file: bool = True) -> DataFrame:
    """Landed API pages as mutation file rows, all strings; what a record lacks is an empty string.

    A page is a JSON array of records. With ``page_per_file`` it may span lines and one task reads the whole file, files in
    parallel; otherwise every line is a page (or a single record) and large files are split. The declared schema takes
    every scalar as its text, so no pass over the data infers types.
    """
    records = spark.read.schema(RECORD_SCHEMA).json(path, multiLine=page_per_file)
    fields = {"Hugo_Symbol": F.col("gene.hugoGeneSymbol"), **{c: F.col(f) for c, f in RECORD_FIELDS.items()}}
    empty = F.lit("")
    return records.select(*[F.coalesce(fields[c], empty).alias(c) if c in fields else empty.alias(c) for c in MAF_COLUMNS])
