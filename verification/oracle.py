"""The models in plain SQL for DuckDB, as named parts that each statement pulls in as it needs them."""

from __future__ import annotations

import re

from verification import expected
from verification.expected import DECIMAL_NUMBER, ISO_DATE
from verification.projection import RAW_SQL, oracle_raw

AS_OF_YEAR = 2024


def date(text: str) -> str:
    return f"try_cast(regexp_extract({text}, '{ISO_DATE}', 1) as date)"


def number(text: str) -> str:
    return f"case when regexp_matches({text}, '{DECIMAL_NUMBER}') then try_cast(trim({text}) as double) end"


def literal(value) -> str:
    return "null" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as t({columns})"


def numbered(id_column: str, order: list[str], columns: list[str], rows: str, hidden: tuple[str, ...] = ()) -> str:
    ties = [*order, *[c for c in [*columns, *hidden] if c not in order]]
    by = ", ".join(f"{c} asc nulls last" for c in ties)
    return f"select row_number() over (order by {by}) as {id_column}, {', '.join(columns)} from {rows}"


PARTS: dict[str, str] = {name: oracle_raw(name) for name in RAW_SQL}
PARTS |= {
    "concept": """select try_cast(CONCEPT_ID as bigint) as concept_id, VOCABULARY_ID as vocabulary_id,
        STANDARD_CONCEPT as standard_concept, CONCEPT_CODE as concept_code from vocab__concept""",
    "concept_map": values(
        [tuple(int(c) if i == 8 and c else c for i, c in enumerate(row)) for row in expected.cells(expected.CONCEPT_MAP)],
        "source, source_field, source_value, omop_table, omop_field, target_domain, target_vocabulary, source_code, "
        "concept_id, review_status, notes",
    ),
    "cdm_v54_tables": values([tuple(row[:3]) for row in expected.cells(expected.TABLES)], "cdm_table_name, cdm_schema, is_required"),
    "cdm_scope": values([(row[0], *row[3:]) for row in expected.cells(expected.TABLES)], "cdm_table_name, status, reason"),
    "signed": "select * from concept_map where review_status = 'STANDARD'",
    "stg_synthea_patients": f"""select Id as person_source_value, GENDER as gender_source_value,
        lower(RACE) as race_source_value, lower(ETHNICITY) as ethnicity_source_value,
        {date("BIRTHDATE")} as birth_date, {date("DEATHDATE")} as death_date from synthea__patients""",
    "stg_synthea_conditions": f"""select PATIENT as person_source_value, CODE as snomed_code,
        DESCRIPTION as condition_source_value, {date("START")} as condition_start_date from synthea__conditions""",
    "stg_synthea_encounters": f"""select Id as visit_source_value, PATIENT as person_source_value,
        ENCOUNTERCLASS as encounter_class, {date("START")} as visit_start_date, {date("STOP")} as visit_end_date
        from synthea__encounters""",
    "stg_synthea_medications": f"""select PATIENT as person_source_value, CODE as rxnorm_code,
        DESCRIPTION as drug_source_value, {date("START")} as drug_exposure_start_date,
        {date("STOP")} as drug_exposure_end_date, {number("DISPENSES")} as dispenses,
        REASONCODE as reason_snomed_code from synthea__medications""",
    "stg_synthea_observations": f"""select PATIENT as person_source_value, CODE as loinc_code,
        DESCRIPTION as measurement_source_value, {number("VALUE")} as value_as_number,
        UNITS as unit_source_value, {date("DATE")} as measurement_date
        from synthea__observations where TYPE = 'numeric'""",
    "stg_synthea_procedures": f"""select PATIENT as person_source_value, CODE as snomed_code,
        DESCRIPTION as procedure_source_value, {date("START")} as procedure_date,
        REASONCODE as reason_snomed_code from synthea__procedures""",
    "stg_metabric_patient": f"""select PATIENT_ID as person_source_value, 'F' as gender_source_value,
        {number("AGE_AT_DIAGNOSIS")} as age_at_diagnosis, VITAL_STATUS as vital_status, OS_STATUS as os_status,
        {number("OS_MONTHS")} as os_months from metabric__data_clinical_patient""",
    "stg_metabric_sample": f"""select PATIENT_ID as person_source_value, SAMPLE_ID as sample_id,
        CANCER_TYPE_DETAILED as cancer_type_detailed, ER_STATUS as er_status, PR_STATUS as pr_status,
        HER2_STATUS as her2_status, TUMOR_STAGE as tumor_stage, GRADE as grade,
        {number("TUMOR_SIZE")} as tumor_size_mm from metabric__data_clinical_sample""",
    "stg_tcga_patient": """select PATIENT_ID as person_source_value,
        case when upper(SEX) in ('F', 'FEMALE') then 'F' when upper(SEX) in ('M', 'MALE') then 'M' end
            as gender_source_value,
        AJCC_PATHOLOGIC_TUMOR_STAGE as ajcc_stage from tcga_brca__data_clinical_patient""",
    "stg_tcga_sample": """select PATIENT_ID as person_source_value, SAMPLE_ID as sample_id,
        CANCER_TYPE_DETAILED as cancer_type_detailed, cast(null as varchar) as er_status
        from tcga_brca__data_clinical_sample""",
    "people": """select 'synthea' as source, person_source_value, gender_source_value, race_source_value,
            ethnicity_source_value, birth_date from stg_synthea_patients
        union all by name select 'metabric' as source, person_source_value, gender_source_value from stg_metabric_patient
        union all by name select 'tcga_brca' as source, person_source_value, gender_source_value from stg_tcga_patient""",
    "people_mapped": """select s.*, coalesce(g.concept_id, 0) as gender_concept_id,
            coalesce(r.concept_id, 0) as race_concept_id, coalesce(e.concept_id, 0) as ethnicity_concept_id
        from people s
        left join (select distinct source_value, concept_id from concept_map
                   where omop_field = 'gender_concept_id' and source_value <> '') g
            on s.gender_source_value = g.source_value
        left join (select * from concept_map where source_field = 'patients.RACE') r
            on s.race_source_value = r.source_value
        left join (select * from concept_map where source_field = 'patients.ETHNICITY') e
            on s.ethnicity_source_value = e.source_value""",
    "person_rows": """select gender_concept_id, year(birth_date) as year_of_birth, birth_date as birth_datetime,
        race_concept_id, ethnicity_concept_id, person_source_value, gender_source_value from people_mapped""",
    "person": numbered(
        "person_id",
        ["person_source_value"],
        [
            "gender_concept_id", "year_of_birth", "birth_datetime", "race_concept_id", "ethnicity_concept_id",
            "person_source_value", "gender_source_value",
        ],
        "person_rows",
    ),
    "visit_classes": """select visit_source_value, person_source_value, encounter_class, visit_start_date,
        visit_end_date, case when lower(encounter_class) = 'inpatient' then 9201
            when lower(encounter_class) = 'emergency' then 9203
            when lower(encounter_class) in ('ambulatory', 'outpatient', 'wellness') then 9202 else 0 end
            as visit_concept_id from stg_synthea_encounters""",
    "visit_rows": """select person_id, visit_concept_id, visit_start_date, visit_end_date,
        encounter_class as visit_source_value from visit_classes join person using (person_source_value)""",
    "visit_occurrence": numbered(
        "visit_occurrence_id",
        ["visit_start_date", "person_id"],
        ["person_id", "visit_concept_id", "visit_start_date", "visit_end_date", "visit_source_value"],
        "visit_rows",
    ),
    "conditions_coded": """select c.*, coalesce(v.concept_id, 0) as condition_concept_id from stg_synthea_conditions c
        left join concept v on v.concept_code = c.snomed_code and v.vocabulary_id = 'SNOMED'
            and v.standard_concept = 'S'""",
    "diagnoses_coded": """select s.*, coalesce(h.concept_id, 0) as condition_concept_id from (
            select 'metabric' as source, person_source_value, sample_id, cancer_type_detailed from stg_metabric_sample
            union all
            select 'tcga_brca', person_source_value, sample_id, cancer_type_detailed from stg_tcga_sample) s
        left join (select * from signed where omop_field = 'condition_concept_id' and source_value <> '') h
            on h.source = s.source and h.source_value = s.cancer_type_detailed""",
    "condition_rows": """select person_id, condition_concept_id, condition_start_date, condition_source_value,
            snomed_code from conditions_coded join person using (person_source_value)
        union all
        select person_id, condition_concept_id, null, cancer_type_detailed, null
        from diagnoses_coded join person using (person_source_value)""",
    "condition_occurrence": numbered(
        "condition_occurrence_id",
        ["condition_start_date", "person_id"],
        ["person_id", "condition_concept_id", "condition_start_date", "condition_source_value", "snomed_code"],
        "condition_rows",
    ),
    "drugs_coded": """select m.*, coalesce(v.concept_id, 0) as drug_concept_id from stg_synthea_medications m
        left join concept v on v.concept_code = m.rxnorm_code and v.vocabulary_id = 'RxNorm'
            and v.standard_concept = 'S'""",
    "drug_rows": """select person_id, drug_concept_id, drug_exposure_start_date, drug_exposure_end_date,
        dispenses as quantity, drug_source_value, rxnorm_code
        from drugs_coded join person using (person_source_value)""",
    "drug_exposure": numbered(
        "drug_exposure_id",
        ["drug_exposure_start_date", "person_id"],
        [
            "person_id", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date", "quantity",
            "drug_source_value", "rxnorm_code",
        ],
        "drug_rows",
    ),
    "procedures_coded": """select m.*, coalesce(v.concept_id, 0) as procedure_concept_id
        from stg_synthea_procedures m
        left join concept v on v.concept_code = m.snomed_code and v.vocabulary_id = 'SNOMED'
            and v.standard_concept = 'S'""",
    "procedure_rows": """select person_id, procedure_concept_id, procedure_date, procedure_source_value, snomed_code
        from procedures_coded join person using (person_source_value)""",
    "procedure_occurrence": numbered(
        "procedure_occurrence_id",
        ["procedure_date", "person_id"],
        ["person_id", "procedure_concept_id", "procedure_date", "procedure_source_value", "snomed_code"],
        "procedure_rows",
    ),
    "results_coded": """select o.*, coalesce(v.concept_id, 0) as measurement_concept_id
        from stg_synthea_observations o
        left join concept v on v.concept_code = o.loinc_code and v.vocabulary_id = 'LOINC'""",
    "tumour_facts": """select * from (values
            ('ER_STATUS', '85337-4', 'ER status', 'word'), ('PR_STATUS', '85339-0', 'PR status', 'word'),
            ('HER2_STATUS', '48676-1', 'HER2 status', 'word'), ('TUMOR_SIZE', '21889-1', 'Tumor size', 'size'),
            ('GRADE', '44648-4', 'Histologic grade', 'grade')) as f(field, code, title, kind)""",
    "tumour_attributes": f"""select person_source_value, 'data_clinical_sample.' || field as source_field,
            code as loinc_code, case kind when 'size' then tumor_size_mm when 'grade' then {number("cell")} end as value_num,
            case when kind <> 'size' then cell end as value_txt, case when kind = 'size' then 'mm' end as unit, title as label
        from (select *, case field when 'ER_STATUS' then er_status when 'PR_STATUS' then pr_status
                  when 'HER2_STATUS' then her2_status when 'GRADE' then grade end as cell
              from stg_metabric_sample cross join tumour_facts)
        where coalesce(cell, '') <> '' or (kind = 'size' and tumor_size_mm is not null)""",
    "tumour_coded": """select a.*, v.concept_id as value_as_concept_id, u.concept_id as unit_concept_id
        from tumour_attributes a
        left join (select * from signed where omop_field = 'value_as_concept_id' and omop_table = 'measurement'
                   and source = 'metabric' and source_value <> '') v
            on v.source_field = a.source_field and v.source_value = a.value_txt
        left join (select * from signed where omop_field = 'unit_concept_id' and source_code = 'mm') u
            on a.unit = 'mm'""",
    "measurement_rows": """select person_id, measurement_concept_id, measurement_date, value_as_number,
            cast(null as bigint) as value_as_concept_id, cast(null as varchar) as value_source_value,
            unit_source_value, cast(null as bigint) as unit_concept_id, measurement_source_value
        from results_coded join person using (person_source_value)
        union all
        select person_id, coalesce(c.concept_id, 0), null, value_num, value_as_concept_id, value_txt, unit,
            unit_concept_id, label
        from tumour_coded t join person using (person_source_value)
        left join concept c on c.concept_code = t.loinc_code and c.vocabulary_id = 'LOINC'""",
    "measurement": numbered(
        "measurement_id",
        ["measurement_date", "person_id"],
        [
            "person_id", "measurement_concept_id", "measurement_date", "value_as_number", "value_as_concept_id",
            "value_source_value", "unit_source_value", "unit_concept_id", "measurement_source_value",
        ],
        "measurement_rows",
    ),
    "study_cells": """select 'metabric' as source, person_source_value, unnest([
            {'field': 'data_clinical_patient.AGE', 'cell': null, 'amount': age_at_diagnosis, 'title': 'Age at diagnosis'},
            {'field': 'data_clinical_patient.OS_MONTHS', 'cell': null, 'amount': os_months, 'title': 'Survival time'},
            {'field': 'data_clinical_patient.VITAL_STATUS', 'cell': vital_status, 'amount': null, 'title': 'Vital status'}]) as c
        from stg_metabric_patient
        union all select 'metabric', person_source_value,
            {'field': 'data_clinical_sample.TUMOR_STAGE', 'cell': tumor_stage, 'amount': STAGE_NUMBER, 'title': 'Tumor stage'}
        from stg_metabric_sample
        union all select 'tcga_brca', person_source_value, {'field': 'data_clinical_patient.AJCC_PATHOLOGIC_TUMOR_STAGE',
            'cell': ajcc_stage, 'amount': null, 'title': 'AJCC stage'} from stg_tcga_patient""".replace(
        "STAGE_NUMBER", number("tumor_stage")
    ),
    "observed": """select source, c.field as source_field, person_source_value, c.amount as value_num,
            c.cell as value_txt, c.title as label
        from study_cells where c.amount is not null or coalesce(c.cell, '') <> ''""",
    "observed_coded": """select a.*, coalesce(o.concept_id, 0) as observation_concept_id,
            u.concept_id as unit_concept_id, v.concept_id as value_as_concept_id
        from observed a
        left join (select * from signed where omop_field = 'observation_concept_id') o
            on o.source = a.source and o.source_field = a.source_field
        left join (select * from signed where omop_field = 'unit_concept_id' and omop_table = 'observation') u
            on u.source = a.source and u.source_field = a.source_field
        left join (select * from signed where omop_field = 'value_as_concept_id' and omop_table = 'observation'
                   and source_value <> '') v
            on v.source = a.source and v.source_field = a.source_field and v.source_value = a.value_txt""",
    "observation_rows": """select person_id, observation_concept_id, cast(null as date) as observation_date,
        value_num as value_as_number, value_as_concept_id, value_txt as value_source_value, unit_concept_id,
        label as observation_source_value, person_source_value
        from observed_coded join person using (person_source_value)""",
    "observation": numbered(
        "observation_id",
        ["person_source_value", "person_id"],
        [
            "person_id", "observation_concept_id", "observation_date", "value_as_number", "value_as_concept_id",
            "value_source_value", "unit_concept_id", "observation_source_value",
        ],
        "observation_rows",
    ),
    "death": """select person_id, death_date, 32817 as death_type_concept_id
        from stg_synthea_patients join person using (person_source_value) where death_date is not null""",
    "events_dated": """select person_id, visit_start_date as event_date from visit_rows
        union all select person_id, visit_end_date from visit_rows
        union all select person_id, condition_start_date from condition_rows
        union all select person_id, measurement_date from measurement_rows
        union all select person_id, drug_exposure_start_date from drug_rows
        union all select person_id, drug_exposure_end_date from drug_rows
        union all select person_id, procedure_date from procedure_rows""",
    "period_rows": """select person_id, min(event_date) as observation_period_start_date,
        max(event_date) as observation_period_end_date, 32817 as period_type_concept_id
        from events_dated where event_date is not null group by person_id""",
    "observation_period": numbered(
        "observation_period_id",
        ["person_id"],
        ["person_id", "observation_period_start_date", "observation_period_end_date", "period_type_concept_id"],
        "period_rows",
    ),
    "metabric_mutations": "select * from metabric__data_mutations",
    "tcga_brca_mutations": "select * from tcga_brca__data_mutations",
    "sample_person": """select s.source, s.sample_id, s.person_source_value as patient_id, p.person_id from (
            select 'metabric' as source, sample_id, person_source_value from stg_metabric_sample
            union all select 'tcga_brca', sample_id, person_source_value from stg_tcga_sample) s
        left join person p on p.person_source_value = s.person_source_value""",
    "person_deid": f"""select person_id, gender_concept_id, case when {AS_OF_YEAR} - year_of_birth > 89
        then {AS_OF_YEAR - 90} else year_of_birth end as year_of_birth, race_concept_id, ethnicity_concept_id
        from person""",
    "condition_occurrence_deid": """select condition_occurrence_id, person_id, condition_concept_id,
        year(condition_start_date) as condition_start_year from condition_occurrence""",
    "measurement_deid": """select measurement_id, person_id, measurement_concept_id,
        year(measurement_date) as measurement_year, value_as_number, value_as_concept_id, value_source_value,
        unit_concept_id, measurement_source_value from measurement""",
    "observation_deid": """select observation_id, person_id, observation_concept_id,
        year(observation_date) as observation_year, value_as_number, value_as_concept_id, value_source_value,
        unit_concept_id, observation_source_value from observation""",
    "visit_occurrence_deid": """select visit_occurrence_id, person_id, visit_concept_id,
        year(visit_start_date) as visit_start_year, year(visit_end_date) as visit_end_year from visit_occurrence""",
    "drug_exposure_deid": """select drug_exposure_id, person_id, drug_concept_id,
        year(drug_exposure_start_date) as drug_exposure_start_year,
        year(drug_exposure_end_date) as drug_exposure_end_year, quantity from drug_exposure""",
    "procedure_occurrence_deid": """select procedure_occurrence_id, person_id, procedure_concept_id,
        year(procedure_date) as procedure_year from procedure_occurrence""",
    "observation_period_deid": """select observation_period_id, person_id,
        year(observation_period_start_date) as observation_period_start_year,
        year(observation_period_end_date) as observation_period_end_year, period_type_concept_id
        from observation_period""",
    "mutations_deid": """select p.person_id, m.source, Hugo_Symbol as hugo_symbol, Entrez_Gene_Id as entrez_gene_id,
            Chromosome as chromosome, Start_Position as start_position,
            Variant_Classification as variant_classification, Variant_Type as variant_type,
            HGVSp_Short as protein_change
        from (select 'metabric' as source, * from metabric_mutations
              union all by name select 'tcga_brca' as source, * from tcga_brca_mutations) m
        join sample_person p on p.sample_id = m.Tumor_Sample_Barcode where p.person_id is not null""",
    "unique_patients": """select p.person_id, p.gender_concept_id, p.year_of_birth,
            coalesce(c.n, 0) as distinct_conditions, coalesce(m.n, 0) as distinct_mutated_genes
        from person_deid p
        left join (select person_id, count(distinct condition_concept_id) as n from condition_occurrence_deid group by 1) c
            using (person_id)
        left join (select person_id, count(distinct hugo_symbol) as n from mutations_deid group by 1) m
            using (person_id)""",
    "short_periods": """select person_id, observation_period_start_date,
        cast(observation_period_start_date + 365 as date) as observation_period_end_date from period_rows""",
    "events_outside": """select e.person_id, e.src, e.event_date, o.observation_period_start_date,
            o.observation_period_end_date
        from (select person_id, 'condition' as src, condition_start_date as event_date from condition_rows
              union all select person_id, 'visit', visit_start_date from visit_rows
              union all select person_id, 'drug', drug_exposure_start_date from drug_rows
              union all select person_id, 'procedure', procedure_date from procedure_rows) e
        join short_periods o using (person_id)
        where e.event_date not between o.observation_period_start_date and o.observation_period_end_date""",
}
_QUOTED = re.compile(r"'[^']*'")
_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def statement(final: str) -> str:
    """``final`` preceded by the parts it uses, each defined before its first use."""
    order: list[str] = []

    def need(sql: str, own: str | None = None) -> None:
        for word in dict.fromkeys(_WORD.findall(_QUOTED.sub("", sql))):
            if word in PARTS and word != own and word not in order:
                need(PARTS[word], word)
                order.append(word)

    need(final)
    if not order:
        return final
    return "with " + ",\n".join(f"{name} as ({PARTS[name]})" for name in order) + "\n" + final


def whole(part: str, dates: tuple[str, ...] = ()) -> str:
    """All rows of a part, with dates as ISO text."""
    replaced = ", ".join(f"cast({d} as varchar) as {d}" for d in dates)
    return statement(f"select *{f' replace ({replaced})' if dates else ''} from {part}")


def check_sql() -> list[str]:
    """Every declared check counted on its own."""
    lines = []
    for name, table, column, category, severity, where, counted in expected.cells(expected.CHECKS):
        kind, _, what = counted.partition(": ")
        if kind == "rows":
            count = f"select count(*) from {table} where ({where}) and ({what})"
        elif kind == "values":
            count = f"select count(distinct {column}) from {table} where ({where}) and {what}"
        else:
            count = f"select count(*) from (select 1 from {table} where {what} is not null group by {what} having count(*) > 1)"
        about = [name, table, column, category, severity]
        lines.append(f"select {', '.join(literal(a) for a in about)}, ({count})")
    return lines


EVENTS_OUTSIDE = """select count(*) from (
        select person_id, condition_start_date as d from condition_occurrence
        union all select person_id, visit_start_date from visit_occurrence
        union all select person_id, drug_exposure_start_date from drug_exposure
        union all select person_id, procedure_date from procedure_occurrence) e
    join observation_period o using (person_id)
    where d < observation_period_start_date or d > observation_period_end_date"""
COVERAGE = """select count(*) from (
        select cdm_table_name from cdm_v54_tables where is_required = 'TRUE'
            and cdm_table_name not in (select cdm_table_name from cdm_scope where status = 'BUILT')
        union all select cdm_table_name from cdm_v54_tables where cdm_table_name not in (select cdm_table_name from cdm_scope)
        union all select cdm_table_name from cdm_scope where status = 'BUILT' and cdm_table_name not in (
            'person', 'observation_period', 'visit_occurrence', 'condition_occurrence', 'drug_exposure',
            'procedure_occurrence', 'measurement', 'observation', 'death'))"""


def report_sql() -> str:
    """The declared checks, then the checks across tables and the coverage gate."""
    lines = check_sql()
    for name, table, category, count in [
        ("death_before_birth", "death", "plausibility",
         "select count(*) from death join person using (person_id) where death_date < birth_datetime"),
        ("events_outside_period", "observation_period", "plausibility", EVENTS_OUTSIDE),
        ("cdm_coverage", "cdm_scope", "completeness", COVERAGE),
        ("shared_patient_ids", "person", "conformance",
         "select count(*) from (select person_source_value from person group by 1 having count(*) > 1)"),
        ("repeated_map_keys", "concept_map", "conformance",
         "select count(*) from (select 1 from concept_map group by source, source_field, source_value, omop_table, "
         "omop_field having count(*) > 1)"),
    ]:
        lines.append(f"select '{name}', '{table}', null, '{category}', 'error', ({count})")
    return statement(
        "select check_name, table_name, column_name, category, severity, violations, case when violations = 0 then 'PASS' "
        "when severity = 'warn' then 'WARN' else 'ERROR' end as status from ("
        + "\nunion all ".join(lines)
        + ") as t(check_name, table_name, column_name, category, severity, violations)"
    )


def anonymity_sql(k: int, what: str) -> str:
    """The steps over the de-identified people, the combinations that are rare, or the people at the chosen step."""
    band = lambda n: (
        f"(year_of_birth // {n} * {n})::varchar || '-' || (year_of_birth // {n} * {n} + {n - 1})::varchar"
    )
    either = lambda column, level: (
        f"case {level} when 0 then coalesce({column}::varchar, 'unknown') else '*' end"
    )
    values = f"""case y when 0 then coalesce(year_of_birth::varchar, 'unknown') when 4 then '*' else coalesce(case y
            when 1 then {band(5)} when 2 then {band(10)} else {band(25)} end, 'unknown') end as year_of_birth,
        {either("race_concept_id", "r")} as race_concept_id, {either("ethnicity_concept_id", "e")} as ethnicity_concept_id,
        {either("gender_concept_id", "g")} as gender_concept_id"""
    if what == "small":
        return statement(
            "select year_of_birth, race_concept_id, ethnicity_concept_id, gender_concept_id, count(*) as n_people from person_deid "
            f"group by all having count(*) < {k}"
        )
    steps = f"""steps as (
        select y::varchar || r::varchar || e::varchar || g::varchar as levels, y + r + e + g as height, count(*) as n_classes,
               min(n) as smallest_class, count(*) filter (where n < {k}) as n_small_classes,
               (coalesce(sum(n) filter (where n < {k}), 0))::bigint as n_people_at_risk,
               coalesce(sum(n) filter (where n < {k}), 0) / sum(n) as share_at_risk, y, r, e, g
        from (select y, r, e, g, year_of_birth, race_concept_id, ethnicity_concept_id, gender_concept_id, count(*) as n
              from (select person_id, y, r, e, g, {values} from person_deid, range(5) as a(y), range(2) as b(r), range(2) as c(e), range(2) as d(g))
              group by all) group by y, r, e, g),
    best as (select levels as best from steps where share_at_risk <= 0 order by height, n_classes desc, g, e, r, y limit 1)"""
    if what == "report":
        final = "select * exclude (y, r, e, g, best), levels is not distinct from best as chosen from steps left join best on true"
    else:
        final = (
            f"select person_id, {values} from (select * from person_deid, (select y, r, e, g from steps join best on levels = best))"
        )
    return statement("select * from person_deid").rsplit("\n", 1)[0] + ",\n" + steps + "\n" + final


#: Table, column, kind, category, severity, and the violations in SQL.
ARRIVALS = """
stg_synthea_patients | person_source_value | not_null | conformance | error | count(*) filter (where person_source_value is null)
stg_synthea_patients | person_source_value | unique | conformance | error | {again}
stg_synthea_patients | gender_source_value | accepted_values | conformance | error | count(distinct gender_source_value) filter (where gender_source_value not in ('F', 'M'))
stg_synthea_patients | birth_date | not_null | completeness | warn | count(*) filter (where birth_date is null)
stg_synthea_patients | birth_date | between | plausibility | error | count(*) filter (where year(birth_date) < 1900 or year(birth_date) > 2100)
stg_synthea_patients | death_date | expression_is_true | plausibility | error | count(*) filter (where death_date < birth_date)
stg_synthea_encounters | visit_source_value | not_null | conformance | error | count(*) filter (where visit_source_value is null)
stg_synthea_encounters | visit_source_value | unique | conformance | error | {again}
stg_synthea_encounters | person_source_value | relationships | conformance | error | {orphans}
stg_synthea_encounters | visit_start_date | not_null | completeness | error | count(*) filter (where visit_start_date is null)
stg_synthea_encounters | visit_end_date | expression_is_true | plausibility | error | count(*) filter (where visit_end_date < visit_start_date)
stg_synthea_encounters | encounter_class | accepted_values | conformance | error | count(distinct encounter_class) filter (where encounter_class not in ('inpatient', 'emergency', 'ambulatory', 'outpatient', 'wellness'))
stg_synthea_conditions | person_source_value | relationships | conformance | error | {orphans}
stg_synthea_conditions | condition_start_date | not_null | completeness | error | count(*) filter (where condition_start_date is null)
stg_synthea_medications | person_source_value | relationships | conformance | error | {orphans}
stg_synthea_medications | drug_exposure_start_date | not_null | completeness | error | count(*) filter (where drug_exposure_start_date is null)
stg_synthea_medications | drug_exposure_end_date | expression_is_true | plausibility | error | count(*) filter (where drug_exposure_end_date < drug_exposure_start_date)
stg_synthea_medications | dispenses | between | plausibility | warn | count(*) filter (where dispenses < 1 or dispenses > 40)
stg_synthea_observations | person_source_value | relationships | conformance | error | {orphans}
stg_synthea_observations | measurement_date | not_null | completeness | error | count(*) filter (where measurement_date is null)
stg_synthea_observations | value_as_number | not_null | completeness | warn | count(*) filter (where unit_source_value <> '' and value_as_number is null)
stg_synthea_procedures | person_source_value | relationships | conformance | error | {orphans}
stg_synthea_procedures | procedure_date | not_null | completeness | error | count(*) filter (where procedure_date is null)
"""


def arrivals_sql() -> str:
    """The checks on arriving files over the whole tables."""
    lines = []
    for line in ARRIVALS.strip().splitlines():
        table, column, kind, category, severity, count = (part.strip() for part in line.split(" | ", 5))
        known = "person_source_value not in (select person_source_value from stg_synthea_patients)"
        if "{again}" in count:  # keys that several rows have, each once
            count = f"select count(*) from (select 1 from {table} where {column} is not null group by {column} having count(*) > 1)"
        else:
            count = f"select {count.replace('{orphans}', f'count(*) filter (where {known})')} from {table}"
        name = f"{kind}_{table}_{column}" + ("_stg_synthea_patients" if kind == "relationships" else "")
        lines.append(f"select {', '.join(map(literal, (name, table, column, category, severity)))}, ({count})")
    return statement(
        "select *, case when violations = 0 then 'PASS' when severity = 'warn' then 'WARN' else 'ERROR' end as status from ("
        + "\nunion all ".join(lines)
        + ") as t(check_name, table_name, column_name, category, severity, violations)"
    )


def trend_sql(what: str) -> str:
    """Three runs of the visit checks over a third of the orders each, and what changed between them."""
    listed = "'inpatient', 'emergency', 'ambulatory', 'outpatient', 'wellness'"
    view, rows = "stg_synthea_encounters", []
    for run in (1, 2, 3):
        own = f"(select * from {view} where substr(visit_source_value, 2)::bigint % 3 = {run - 1})"
        classes = listed if run == 1 else f"{listed}, 'urgentcare', 'Wellness'"
        for name, category, count in (
            (f"not_null_{view}_visit_source_value", "conformance", "count(*) filter (where visit_source_value is null)"),
            (f"unique_{view}_visit_source_value", "conformance", None),
            (f"relationships_{view}_person_source_value_stg_synthea_patients", "conformance",
             "count(*) filter (where person_source_value not in (select person_source_value from stg_synthea_patients))"),
            (f"not_null_{view}_visit_start_date", "completeness", "count(*) filter (where visit_start_date is null)"),
            (f"expression_is_true_{view}_visit_end_date", "plausibility", "count(*) filter (where visit_end_date < visit_start_date)"),
            (f"accepted_values_{view}_encounter_class", "conformance", f"count(distinct encounter_class) filter (where encounter_class not in ({classes}))"),
        ):
            counted = f"select {count} from {own}" if count else f"select count(*) from (select 1 from {own} group by visit_source_value having count(*) > 1)"
            rows.append(f"select {run}::bigint as run, '{name}' as check_name, '{category}' as category, ({counted}) as violations")
    base = "reports as (" + "\nunion all ".join(rows) + ")"
    if what == "rates":
        final = """rates as (select run, category, count(*) as n_checks, count(*) filter (where violations = 0) as n_passed,
                count(*) filter (where violations = 0) / count(*) as pass_rate from reports group by run, category)
            select *, pass_rate - lag(pass_rate) over (partition by category order by run) as change,
                max(pass_rate) over (partition by category order by run) - pass_rate > 0.05 as drifted from rates"""
    else:
        final = """seen as (select *, violations > 0 as failing, lag(violations) over w as previous, lag(violations > 0) over w as was_failing,
                coalesce(max(run) filter (where violations = 0) over (partition by check_name order by run), 0) as last_pass
            from reports window w as (partition by check_name order by run))
            select check_name, run, case when failing then 'ERROR' else 'PASS' end as status, violations, previous, violations - previous as change,
                case when failing then (select min(r.run) from reports r where r.check_name = seen.check_name and r.run > last_pass) end as failing_since,
                case when failing then run - last_pass else 0 end as runs_failing,
                case when failing and was_failing is null then 'first failure' when failing and not was_failing then 'broke'
                    when not failing and was_failing then 'fixed' when failing and violations > previous then 'worse'
                    when failing and violations < previous then 'better' end as event from seen"""
    return statement("select * from stg_synthea_encounters, stg_synthea_patients").rsplit("\n", 1)[0] + ",\n" + base + ",\n" + final


#: The fields of the clinical tables as they are built.
MODEL_FIELDS = """
person person_id:bigint gender_concept_id:bigint year_of_birth:bigint birth_datetime:date race_concept_id:bigint ethnicity_concept_id:bigint person_source_value:string gender_source_value:string
visit_occurrence visit_occurrence_id:bigint person_id:bigint visit_concept_id:bigint visit_start_date:date visit_end_date:date visit_source_value:string
condition_occurrence condition_occurrence_id:bigint person_id:bigint condition_concept_id:bigint condition_start_date:date condition_source_value:string snomed_code:string
drug_exposure drug_exposure_id:bigint person_id:bigint drug_concept_id:bigint drug_exposure_start_date:date drug_exposure_end_date:date quantity:double drug_source_value:string rxnorm_code:string
procedure_occurrence procedure_occurrence_id:bigint person_id:bigint procedure_concept_id:bigint procedure_date:date procedure_source_value:string snomed_code:string
measurement measurement_id:bigint person_id:bigint measurement_concept_id:bigint measurement_date:date value_as_number:double value_as_concept_id:bigint value_source_value:string unit_source_value:string unit_concept_id:bigint measurement_source_value:string
observation observation_id:bigint person_id:bigint observation_concept_id:bigint observation_date:date value_as_number:double value_as_concept_id:bigint value_source_value:string unit_concept_id:bigint observation_source_value:string
observation_period observation_period_id:bigint person_id:bigint observation_period_start_date:date observation_period_end_date:date period_type_concept_id:bigint
death person_id:bigint death_date:date death_type_concept_id:bigint
"""


def conformance_sql(spec: list[tuple]) -> str:
    """Schemas against the published fields (``spec``), then the values of required and of limited fields."""
    model = [(t, *field.split(":")) for t, *fields in map(str.split, MODEL_FIELDS.strip().splitlines()) for field in fields]
    structure = f"""select coalesce(s.t, m.t) as table_name, coalesce(s.f, m.f) as field_name,
            case when m.f is null and required = 'TRUE' then 'ABSENT_REQUIRED' when m.f is null then 'ABSENT_OPTIONAL'
                 when s.f is null then 'EXTRA' when actual <> case split_part(expected, '(', 1) when 'integer' then 'bigint'
                 when 'float' then 'double' when 'datetime' then 'timestamp' when 'varchar' then 'string' else expected end then 'MISTYPED' end as violation,
            expected, actual, null::bigint as n_values
        from ({values(spec, "t, f, required, expected")}) s full join ({values(model, "t, f, actual")}) m on s.t = m.t and s.f = m.f"""
    built, lines = {(t, f): kind for t, f, kind in model}, [f"select * from ({structure}) where violation is not null"]
    for table, field, required, kind in spec:
        actual = built.get((table, field))
        if actual is None:
            continue
        length = kind.removeprefix("varchar(").rstrip(")")
        if length.isdigit():
            lines.append(f"select '{table}', '{field}', 'TOO_LONG', '{kind}', '{actual}', count(*) filter (where length({field}) > {length}) as n from {table} having n > 0")
        if required == "TRUE":
            lines.append(f"select '{table}', '{field}', 'NULL_REQUIRED', 'not null', '{actual}', count(*) filter (where {field} is null) as n from {table} having n > 0")
    return statement("\nunion all ".join(lines))


def lines_sql(*groups: str) -> str:
    """The reconciliation lines of some groups."""
    parts = []
    for group, item, source, modeled, delta, note in expected.cells(expected.LINES):
        if group in groups:
            total = lambda names: " + ".join(f"(select count(*) from {n})" for n in names.split(" + "))
            before = total(source) if source else "cast(null as bigint)"
            parts.append(
                f"select '{group}' as check_group, '{item}' as item, {before} as source_count, {total(modeled)} as modeled_count, "
                f"{total(delta) if delta else f'({before}) - ({total(modeled)})'} as delta, '{note}' as note"
            )
    return "\nunion all ".join(parts)
