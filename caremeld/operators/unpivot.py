"""Wide study columns to one row per attribute, from one scan of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.functions.casts import has_text, number_or_null

# LOINC code of each tumour attribute.
LOINC = {"ER": "85337-4", "PR": "85339-0", "HER2": "48676-1", "TUMOR_SIZE": "21889-1", "GRADE": "44648-4"}


def attribute(field: str, label: str, number: Column | None = None, text: Column | None = None, **extra) -> Column:
    """One unpivoted row; a missing number or text is a typed NULL."""
    return F.struct(
        F.lit(field).alias("source_field"),
        (F.lit(None).cast("double") if number is None else number).alias("value_num"),
        (F.lit(None).cast("string") if text is None else text).alias("value_txt"),
        F.lit(label).alias("label"),
        *[F.lit(value).cast("string").alias(name) for name, value in extra.items()],
    )


def unpivot(df: DataFrame, source: str, attributes: list[Column]) -> DataFrame:
    """(source, person_source_value, attribute columns...), keeping rows that carry a number or a non-empty text."""
    rows = df.select(F.lit(source).alias("source"), "person_source_value", F.inline(F.array(*attributes)))
    return rows.filter(F.col("value_num").isNotNull() | has_text("value_txt"))


def tumour_measurements(metabric_sample: DataFrame) -> DataFrame:
    sample = "data_clinical_sample"
    return unpivot(
        metabric_sample,
        "metabric",
        [
            attribute(f"{sample}.ER_STATUS", "ER status", text=F.col("er_status"), loinc_code=LOINC["ER"], unit=None),
            attribute(f"{sample}.PR_STATUS", "PR status", text=F.col("pr_status"), loinc_code=LOINC["PR"], unit=None),
            attribute(
                f"{sample}.HER2_STATUS", "HER2 status", text=F.col("her2_status"), loinc_code=LOINC["HER2"], unit=None
            ),
            attribute(
                f"{sample}.TUMOR_SIZE",
                "Tumor size",
                number=F.col("tumor_size_mm"),
                loinc_code=LOINC["TUMOR_SIZE"],
                unit="mm",
            ),
            attribute(
                f"{sample}.GRADE",
                "Histologic grade",
                number=number_or_null("grade"),
                text=F.col("grade"),
                loinc_code=LOINC["GRADE"],
                unit=None,
            ),
        ],
    )


def clinical_observations(
    metabric_patient: DataFrame, metabric_sample: DataFrame, tcga_patient: DataFrame
) -> DataFrame:
    patients = unpivot(
        metabric_patient,
        "metabric",
        [
            attribute("data_clinical_patient.AGE", "Age at diagnosis", number=F.col("age_at_diagnosis")),
            attribute("data_clinical_patient.VITAL_STATUS", "Vital status", text=F.col("vital_status")),
            attribute("data_clinical_patient.OS_MONTHS", "Survival time", number=F.col("os_months")),
        ],
    )
    stage = F.col("tumor_stage")
    samples = unpivot(
        metabric_sample,
        "metabric",
        [attribute("data_clinical_sample.TUMOR_STAGE", "Tumor stage", number=number_or_null(stage), text=stage)],
    )
    ajcc = unpivot(
        tcga_patient,
        "tcga_brca",
        [attribute("data_clinical_patient.AJCC_PATHOLOGIC_TUMOR_STAGE", "AJCC stage", text=F.col("ajcc_stage"))],
    )
    return patients.unionByName(samples).unionByName(ajcc)
