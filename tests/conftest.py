from __future__ import annotations

import pytest

from caremeld.plans.layers import Layers
from caremeld.session import local_session
from caremeld.sources import seeds

AS_OF_YEAR = 2024


def pytest_addoption(parser):
    parser.addoption("--all-queries", action="store_true", help="compare every registered query with its SQL on hot keys too")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark, columns: str, rows: list[tuple]):
    """All-string rows, as RAW holds them."""
    names = columns.split()
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def raw(spark):
    """Hand-made raw tables with the edge rows of every operator."""
    maf = ("Tumor_Sample_Barcode Hugo_Symbol Entrez_Gene_Id Chromosome Start_Position Variant_Classification "
           "Variant_Type HGVSp_Short Matched_Norm_Sample_Barcode")  # fmt: skip
    call = ("1", "17", "100", "Missense", "SNP", "p.A1B", "N1")
    return {
        "synthea__patients": frame(
            spark,
            "Id GENDER RACE ETHNICITY BIRTHDATE DEATHDATE",
            [
                ("S1", "F", "White", "NonHispanic", "1950-05-01", ""),
                ("S2", "M", "martian", "hispanic", "2020", "2001-01-01"),
                ("S3", "", "", "", "", "NA"),
                ("S4", "X", "black", "HISPANIC", "2010-13-01", ""),
                ("S5", "F", "asian", "nonhispanic", "1990-02-03", "1980-01-01"),
                ("TWIN", "M", "white", "nonhispanic", "1934-01-01", ""),
            ],
        ),
        "synthea__encounters": frame(
            spark,
            "Id PATIENT ENCOUNTERCLASS START STOP",
            [
                ("E1", "S1", "Wellness", "2010-01-01T00:00:00Z", "2010-01-02T00:00:00Z"),
                ("E2", "S1", "urgentcare", "2011-01-01T00:00:00Z", ""),
                ("E3", "S2", "INPATIENT", "", "2012-03-04T00:00:00Z"),
                ("E4", "GHOST", "emergency", "2010-01-01T00:00:00Z", ""),
                ("E5", "TWIN", "emergency", "2015-01-01T00:00:00Z", "2015-01-01T00:00:00Z"),
            ],
        ),
        "synthea__conditions": frame(
            spark,
            "PATIENT CODE DESCRIPTION START",
            [
                ("S1", "100", "standard", "2009-12-31"),
                ("S1", "200", "not standard", "bad"),
                ("S2", "999", "unknown", "2010-01-01"),
                ("GHOST", "100", "orphan", "2010-01-01"),
            ],
        ),
        "synthea__medications": frame(
            spark,
            "PATIENT CODE DESCRIPTION START STOP DISPENSES REASONCODE",
            [
                ("S1", "300", "standard", "2010-01-01T10:00:00Z", "", " 3.5 ", ""),
                ("S2", "301", "not standard", "2013-01-01T10:00:00Z", "2014-01-01T10:00:00Z", "1d", ""),
            ],
        ),
        "synthea__procedures": frame(
            spark,
            "PATIENT CODE DESCRIPTION START REASONCODE",
            [("S1", "100", "standard", "2010-06-01T00:00:00Z", ""), ("S5", "200", "not standard", "", "")],
        ),
        "synthea__observations": frame(
            spark,
            "PATIENT CODE DESCRIPTION VALUE UNITS TYPE DATE",
            [
                ("S1", "400-1", "not standard", "1.5", "mg", "numeric", "2010-01-01T00:00:00Z"),
                ("S1", "QALY", "no code", "NA", "", "numeric", "2020-01-01T00:00:00Z"),
                ("S1", "400-1", "text", "yes", "", "text", "2030-01-01T00:00:00Z"),
            ],
        ),
        "metabric__data_clinical_patient": frame(
            spark,
            "PATIENT_ID AGE_AT_DIAGNOSIS VITAL_STATUS OS_STATUS OS_MONTHS",
            [
                ("MB1", "45.25", "Living", "0:LIVING", "100.5"),
                ("MB2", "", "", "", ""),
                ("TWIN", "60", "Died of Disease", "1:DECEASED", "12"),
            ],
        ),
        "metabric__data_clinical_sample": frame(
            spark,
            "PATIENT_ID SAMPLE_ID CANCER_TYPE_DETAILED ER_STATUS PR_STATUS HER2_STATUS TUMOR_STAGE GRADE TUMOR_SIZE",
            [
                ("MB1", "MB1", "Breast Invasive Ductal Carcinoma", "Positive", "Negative", "NA", "2", "2", "26.2"),
                ("MB2", "MB2", "Unlisted", "", "", "", "", "NA", ""),
                ("LOST", "LOST-1", "Breast", "Positive", "", "", "9", "", ""),
            ],
        ),
        "metabric__data_mutations": frame(
            spark, maf, [("MB1", "TP53", *call), ("MB1", "TP53", *call), ("LOST-1", "BRCA1", *call)]
        ),
        "tcga_brca__data_clinical_patient": frame(
            spark,
            "PATIENT_ID SEX AJCC_PATHOLOGIC_TUMOR_STAGE",
            [("T1", "Female", "STAGE IIA"), ("T2", "MALE", "STAGE X"), ("T3", "F", ""), ("T4", "", "STAGE I")],
        ),
        "tcga_brca__data_clinical_sample": frame(
            spark,
            "PATIENT_ID SAMPLE_ID CANCER_TYPE_DETAILED",
            [("T1", "T1-01", "Breast Invasive Lobular Carcinoma"), ("T2", "T2-01", "Breast")],
        ),
        "tcga_brca__data_mutations": frame(
            spark, maf, [("T1-01", "PIK3CA", *call), ("T1-01", "GATA3", *call), ("T2-01", "TP53", *call)]
        ),
    }


@pytest.fixture(scope="session")
def vocabulary(spark):
    rows = [
        (1001, "SNOMED", "S", "100"),
        (2001, "SNOMED", "", "200"),
        (3001, "RxNorm", "S", "300"),
        (3011, "RxNorm", "", "301"),
        (4001, "LOINC", "", "400-1"),
        (5001, "LOINC", "S", "85337-4"),
        (6001, "LOINC", "S", "100"),
    ]
    return spark.createDataFrame(
        rows, "CONCEPT_ID long, VOCABULARY_ID string, STANDARD_CONCEPT string, CONCEPT_CODE string"
    )


@pytest.fixture(scope="session")
def models(spark, raw, vocabulary):
    return Layers(raw, vocabulary, seeds.concept_map(spark), AS_OF_YEAR)


def ordered(tuples):
    return sorted(map(tuple, tuples), key=lambda r: tuple((v is not None, str(v)) for v in r))


def rows(df, *columns):
    """Rows as sorted tuples."""
    return ordered((df.select(*columns) if columns else df).collect())
