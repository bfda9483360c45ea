"""Clinical raw tables derived from the test tables, in SQL that Spark and DuckDB read alike (see FIXTURES.md).

The customer key, modulo three, only says which of the three sources a row belongs to: every customer, order, line, event
and part ends up in a raw table. Orders and events, which only the synthetic source has, go to the synthetic patient with
the next lower key. A share of orders, lines, events, samples and variants goes to ids that no table has, one patient id is
used by two sources, and the five codes of the tumour attributes are in the vocabulary.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TEST_TABLES = ["customer", "orders", "lineitem", "events", "part"]

RAW_SQL = {
    "synthea__patients": """
        select 'S' || lpad(cast(c_custkey as string),8,'0') as Id,
        case c_nationkey % 5 when 0 then 'M' when 1 then '' when 2 then 'X' else 'F' end as GENDER,
        case c_mktsegment when 'BUILDING' then 'White' when 'MACHINERY' then 'black' when 'FURNITURE' then 'Asian' when 'HOUSEHOLD' then 'other' else '' end as RACE,
        case c_nationkey % 2 when 0 then 'NonHispanic' else 'hispanic' end as ETHNICITY,
        case when c_custkey % 97 = 0 then '' when c_custkey % 89 = 0 then 'NA' else cast(1915 + c_custkey % 100 as string) || '-' || lpad(cast(1 + c_custkey % 12 as string),2,'0') || '-15' end as BIRTHDATE,
        case when c_custkey % 33 = 0 then '2003-06-01' else '' end as DEATHDATE
        from {customer} where c_custkey % 3 = 0
    """,
    "synthea__encounters": """
        select 'E' || cast(o_orderkey as string) as Id, case when o_orderkey % 41 = 3 then 'S-UNKNOWN' else 'S' || lpad(cast(o_custkey - o_custkey % 3 as string),8,'0') end as PATIENT,
        case o_orderpriority when '1-URGENT' then 'emergency' when '2-HIGH' then 'inpatient' when '3-MEDIUM' then 'ambulatory' when '4-NOT SPECIFIED' then 'Wellness' else 'urgentcare' end as ENCOUNTERCLASS,
        cast(cast(o_orderdate as date) as string) || 'T08:00:00Z' as START,
        case when o_orderkey % 50 = 0 then '' else cast(cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as string) || 'T09:00:00Z' end as STOP
        from {orders}
    """,
    "synthea__conditions": """
        select case when l_orderkey % 43 = 5 then 'S-UNKNOWN' else 'S' || lpad(cast(o_custkey as string),8,'0') end as PATIENT, cast(l_partkey as string) as CODE, 'cond ' || cast(l_partkey as string) as DESCRIPTION,
        case when l_partkey % 101 = 0 then 'bad' else cast(cast(l_shipdate as date) as string) end as START
        from {lineitem} join {orders} on o_orderkey = l_orderkey where o_custkey % 3 = 0 and l_returnflag = 'A'
    """,
    "synthea__medications": """
        select case when l_orderkey % 43 = 5 then 'S-UNKNOWN' else 'S' || lpad(cast(o_custkey as string),8,'0') end as PATIENT, cast(l_partkey as string) as CODE, 'drug ' || cast(l_partkey as string) as DESCRIPTION,
        cast(cast(l_shipdate as date) as string) || 'T10:00:00Z' as START, case when l_linenumber = 1 then '' else cast(cast(l_shipdate as date) + 30 as string) || 'T10:00:00Z' end as STOP,
        cast(l_quantity as string) as DISPENSES, cast(l_suppkey as string) as REASONCODE
        from {lineitem} join {orders} on o_orderkey = l_orderkey where o_custkey % 3 = 0 and l_returnflag = 'N'
    """,
    "synthea__procedures": """
        select case when l_orderkey % 43 = 5 then 'S-UNKNOWN' else 'S' || lpad(cast(o_custkey as string),8,'0') end as PATIENT, cast(l_partkey as string) as CODE, 'proc ' || cast(l_partkey as string) as DESCRIPTION,
        cast(cast(l_shipdate as date) as string) || 'T11:00:00Z' as START, cast(l_suppkey as string) as REASONCODE
        from {lineitem} join {orders} on o_orderkey = l_orderkey where o_custkey % 3 = 0 and l_returnflag = 'R'
    """,
    "synthea__observations": """
        select case when event_id % 47 = 9 then 'S-UNKNOWN' else 'S' || lpad(cast(user_id - user_id % 3 as string),8,'0') end as PATIENT, cast(event_id % 200 as string) as CODE, event_type as DESCRIPTION,
        case event_type when 'error' then 'NA' else cast(value as string) end as VALUE, case event_type when 'view' then 'mg' else '' end as UNITS,
        case event_type when 'signup' then 'text' else 'numeric' end as TYPE, cast(cast(ts as date) as string) || 'T12:00:00Z' as DATE
        from {events}
    """,
    "metabric__data_clinical_patient": """
        select 'MB-' || lpad(cast(c_custkey as string),8,'0') as PATIENT_ID,
        case when c_custkey % 41 = 0 then '' else cast(30 + c_custkey % 60 as string) || '.25' end as AGE_AT_DIAGNOSIS,
        case c_custkey % 4 when 0 then 'Living' when 1 then 'Died of Disease' when 2 then 'Died of Other Causes' else '' end as VITAL_STATUS,
        case c_custkey % 4 when 0 then '0:LIVING' when 3 then '' else '1:DECEASED' end as OS_STATUS,
        case when c_custkey % 5 = 0 then '' else cast(c_custkey % 200 as string) || '.5' end as OS_MONTHS
        from {customer} where c_custkey % 3 = 1
    """,
    "metabric__data_clinical_sample": """
        select case when c_custkey % 31 = 4 then 'MB-UNKNOWN' else 'MB-' || lpad(cast(c_custkey as string),8,'0') end as PATIENT_ID, 'MB-' || lpad(cast(c_custkey as string),8,'0') as SAMPLE_ID, case c_nationkey % 6 when 0 then 'Breast Invasive Ductal Carcinoma' when 1 then 'Breast Invasive Lobular Carcinoma' when 2 then 'Invasive Breast Carcinoma' when 3 then 'Breast' when 4 then 'Unlisted histology' else 'Breast Invasive Ductal Carcinoma' end as CANCER_TYPE_DETAILED,
        case (c_custkey + 0) % 5 when 0 then 'Positive' when 1 then 'Negative' when 2 then 'NA' when 3 then '' else 'Positive' end as ER_STATUS, case (c_custkey + 1) % 5 when 0 then 'Positive' when 1 then 'Negative' when 2 then 'NA' when 3 then '' else 'Positive' end as PR_STATUS, case (c_custkey + 2) % 5 when 0 then 'Positive' when 1 then 'Negative' when 2 then 'NA' when 3 then '' else 'Positive' end as HER2_STATUS,
        case c_custkey % 7 when 5 then 'NA' when 6 then '' else cast(c_custkey % 7 as string) end as TUMOR_STAGE,
        case c_custkey % 4 when 0 then 'NA' else cast(c_custkey % 4 as string) end as GRADE,
        case when c_custkey % 11 = 0 then '' else cast(1 + c_custkey % 182 as string) end as TUMOR_SIZE
        from {customer} where c_custkey % 3 = 1
    """,
    "tcga_brca__data_clinical_patient": """
        select case when c_custkey = 2 then 'MB-00000001' else 'TCGA-' || lpad(cast(c_custkey as string),8,'0') end as PATIENT_ID,
        case c_nationkey % 5 when 0 then 'Female' when 1 then 'MALE' when 2 then 'F' when 3 then '' else 'FEMALE' end as SEX,
        case c_custkey % 5 when 0 then 'STAGE I' when 1 then 'STAGE IIA' when 2 then 'STAGE X' when 3 then '' else 'STAGE IV' end as AJCC_PATHOLOGIC_TUMOR_STAGE
        from {customer} where c_custkey % 3 = 2
    """,
    "tcga_brca__data_clinical_sample": """
        select 'TCGA-' || lpad(cast(c_custkey as string),8,'0') as PATIENT_ID, 'TCGA-' || lpad(cast(c_custkey as string),8,'0') || '-01' as SAMPLE_ID, case c_nationkey % 6 when 0 then 'Breast Invasive Ductal Carcinoma' when 1 then 'Breast Invasive Lobular Carcinoma' when 2 then 'Invasive Breast Carcinoma' when 3 then 'Breast' when 4 then 'Unlisted histology' else 'Breast Invasive Ductal Carcinoma' end as CANCER_TYPE_DETAILED
        from {customer} where c_custkey % 3 = 2
    """,
    "metabric__data_mutations": """
        select 'G' || cast(l_partkey % 25 as string) as Hugo_Symbol, cast(l_partkey as string) as Entrez_Gene_Id, cast(1 + l_suppkey % 22 as string) as Chromosome,
        cast(l_orderkey * 10 + l_linenumber as string) as Start_Position, l_returnflag as Variant_Classification, l_linestatus as Variant_Type,
        'p.' || cast(l_linenumber as string) as HGVSp_Short, case when l_orderkey % 37 = 5 then 'MB-NO-SAMPLE' else 'MB-' || lpad(cast(o_custkey as string),8,'0') end as Tumor_Sample_Barcode, 'N-' || cast(o_custkey as string) as Matched_Norm_Sample_Barcode
        from {lineitem} join {orders} on o_orderkey = l_orderkey where o_custkey % 3 = 1
    """,
    "tcga_brca__data_mutations": """
        select 'G' || cast(l_partkey % 25 as string) as Hugo_Symbol, cast(l_partkey as string) as Entrez_Gene_Id, cast(1 + l_suppkey % 22 as string) as Chromosome,
        cast(l_orderkey * 10 + l_linenumber as string) as Start_Position, l_returnflag as Variant_Classification, l_linestatus as Variant_Type,
        'p.' || cast(l_linenumber as string) as HGVSp_Short, case when l_orderkey % 37 = 5 then 'TCGA-NO-SAMPLE' else 'TCGA-' || lpad(cast(o_custkey as string),8,'0') || '-01' end as Tumor_Sample_Barcode, 'N-' || cast(o_custkey as string) as Matched_Norm_Sample_Barcode
        from {lineitem} join {orders} on o_orderkey = l_orderkey where o_custkey % 3 = 2
    """,
    "vocab__concept_relationship": """
        select p_partkey * 3 + 1 as concept_id_1, (p_partkey + case when p_partkey % 20 = 0 then 10 else 1 end) * 3 + 1 as concept_id_2, 'Maps to' as relationship_id, '' as invalid_reason from {part} where p_partkey % 10 = 0
        union all select p_partkey * 3 + 1, (p_partkey + 2) * 3 + 1, 'Maps to', '' from {part} where p_partkey % 30 = 0
        union all select p_partkey * 3 + 1, (p_partkey - 10) * 3 + 1, 'Maps to', '' from {part} where p_partkey % 50 = 10
        union all select p_partkey * 3 + 1, (p_partkey + 3) * 3 + 1, 'Maps to', 'D' from {part} where p_partkey % 10 = 0
        union all select p_partkey * 3 + 1, (p_partkey + 4) * 3 + 1, 'Is a', '' from {part}
        union all select p_partkey * 3 + 3, p_partkey * 3 + 6, 'Maps to', '' from {part} where p_partkey % 10 = 8
    """,
    "vocab__concept": """
        select cast(p_partkey * 3 + 0 + 1 as string) as CONCEPT_ID, p_name as CONCEPT_NAME, 'Condition' as DOMAIN_ID, 'SNOMED' as VOCABULARY_ID, p_type as CONCEPT_CLASS_ID,
        case when (p_partkey + 0) % 10 = 0 then '' else 'S' end as STANDARD_CONCEPT, cast(p_partkey as string) as CONCEPT_CODE from {part} where p_partkey % 7 <> 0
        union all
        select cast(p_partkey * 3 + 1 + 1 as string) as CONCEPT_ID, p_name as CONCEPT_NAME, 'Measurement' as DOMAIN_ID, 'LOINC' as VOCABULARY_ID, p_type as CONCEPT_CLASS_ID,
        case when (p_partkey + 1) % 10 = 0 then '' else 'S' end as STANDARD_CONCEPT, cast(p_partkey as string) as CONCEPT_CODE from {part} where p_partkey % 7 <> 1
        union all
        select cast(p_partkey * 3 + 2 + 1 as string) as CONCEPT_ID, p_name as CONCEPT_NAME, 'Drug' as DOMAIN_ID, 'RxNorm' as VOCABULARY_ID, p_type as CONCEPT_CLASS_ID,
        case when (p_partkey + 2) % 10 = 0 then '' else 'S' end as STANDARD_CONCEPT, cast(p_partkey as string) as CONCEPT_CODE from {part} where p_partkey % 7 <> 2
        union all select '90000001', 'Estrogen receptor', 'Measurement', 'LOINC', 'Lab Test', 'S', '85337-4'
        union all select '90000002', 'Progesterone receptor', 'Measurement', 'LOINC', 'Lab Test', 'S', '85339-0'
        union all select '90000003', 'HER2', 'Measurement', 'LOINC', 'Lab Test', 'S', '48676-1'
        union all select '90000004', 'Size', 'Measurement', 'LOINC', 'Lab Test', 'S', '21889-1'
        union all select '90000005', 'Grade', 'Measurement', 'LOINC', 'Lab Test', 'S', '44648-4'
    """,
}


_schemas: dict[str, StructType] = {}  # read from each file once

#: The join that five raw tables begin with, and what they take from it.
LINES = "{lineitem} join {orders} on o_orderkey = l_orderkey"
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate", "o_custkey"]


class RawTables(Mapping):
    """The raw tables by name, each worked out when it is first used; every test table is opened once.

    With ``lines`` (a path) the join of lines and orders is written there once, and the tables that begin with it read that.
    This is for those who use all tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, lines: str | None = None) -> None:
        self.spark, self.sf_dir, self._path = spark, sf_dir, lines
        self._files: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def _file(self, name: str) -> DataFrame:
        if name not in self._files:
            path = f"{self.sf_dir}/{name}.parquet"
            read = self.spark.read.schema(_schemas[path]) if path in _schemas else self.spark.read
            self._files[name] = read.parquet(path)
            _schemas[path] = self._files[name].schema
        return self._files[name]

    @cached_property
    def _lines(self) -> DataFrame:
        columns = ", ".join(LINE_COLUMNS)
        lines = self.spark.sql(f"select {columns} from {LINES}", lineitem=self._file("lineitem"), orders=self._file("orders"))
        lines.write.option("compression", "zstd").parquet(self._path)
        return self.spark.read.schema(lines.schema).parquet(self._path)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            sql = RAW_SQL[name]
            if self._path and LINES in sql:
                self._tables[name] = self.spark.sql(sql.replace(LINES, "{lines}"), lines=self._lines)
                return self._tables[name]
            used = {t: self._file(t) for t in TEST_TABLES if "{" + t + "}" in sql}
            self._tables[name] = self.spark.sql(sql, **used)
        return self._tables[name]

    def __iter__(self):
        return (name for name in RAW_SQL if not name.startswith("vocab__"))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def vocabulary(self) -> DataFrame:
        concepts = self["vocab__concept"]
        return concepts.withColumn("CONCEPT_ID", concepts["CONCEPT_ID"].try_cast("long"))


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table over the whole test tables."""
    return RawTables(spark, sf_dir)[name]


def oracle_raw(name: str) -> str:
    return RAW_SQL[name].format(**{t: t for t in TEST_TABLES})
