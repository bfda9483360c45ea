"""All models of one run by name, and the step that materialises them layer by layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import cached_property

from pyspark.sql import DataFrame

from caremeld.operators import concepts, relationships
from caremeld.operators.lookups import BROADCAST_BYTES, broadcast_if_small
from caremeld.plans import clinical, deid, genomic, staging
from caremeld.session import new_path
from caremeld.sources.tables import save_table


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` as written to the shared folder, for what is used more than once."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Layers:
    """Models over raw tables, a vocabulary and a concept map.

    A model is worked out when it is first asked for. The rows of models with a surrogate id are written to the shared
    folder at that point, and the people with their ids; everything else stays a lazy DataFrame. ``rows(name)`` gives
    a fact table without its id and without that write. Code and sample lookups are measured and broadcast up to
    ``broadcast_bytes``. What ``build`` has written is read instead of worked out again. With ``relationships`` (see
    ``operators.relationships``) codes of non-standard concepts resolve to what they map to.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        vocabulary: DataFrame,
        concept_map: DataFrame,
        as_of_year: int | None = None,
        broadcast_bytes: int = BROADCAST_BYTES,
        relationships: DataFrame | None = None,
    ) -> None:
        self.raw, self.vocabulary, self.concept_map, self.as_of_year = raw, vocabulary, concept_map, as_of_year
        self.broadcast_bytes, self.relationships = broadcast_bytes, relationships
        self._codes: dict[tuple[str, bool], DataFrame] = {}
        self._views: dict[str, DataFrame] = {}
        self._done: dict[str, DataFrame] = {}
        self.written: dict[str, DataFrame] = {}

    def staging(self, view: str) -> DataFrame:
        if view not in self._views:
            table, project = staging.VIEWS[view]
            self._views[view] = project(self.raw[table])
        return self._views[view]

    @cached_property
    def person(self) -> DataFrame:
        return _kept(clinical.person(self.rows("person")), "person")

    @cached_property
    def person_keys(self) -> DataFrame:
        """Ids of the people. They are read from written files, whose size tells Spark whether to broadcast them."""
        return clinical.person_keys(self.person)

    @cached_property
    def targets(self) -> DataFrame:
        return relationships.standard_targets(self.vocabulary, self.relationships)

    def codes(self, vocabulary_id: str, standard_only: bool = True) -> DataFrame:
        """Code lookup of one vocabulary, measured once."""
        key = (vocabulary_id, standard_only)
        if key not in self._codes:
            if standard_only and self.relationships is not None:
                lookup = _kept(relationships.mapped_lookup(self.vocabulary, vocabulary_id, self.targets), "codes")
            else:
                lookup = concepts.code_lookup(self.vocabulary, vocabulary_id, standard_only)
            self._codes[key] = broadcast_if_small(lookup, self.broadcast_bytes)
        return self._codes[key]

    def rows(self, table: str) -> DataFrame:
        stg, concept_map = self.staging, self.concept_map
        if table == "person":
            return clinical.person_rows(
                stg("stg_synthea_patients"), stg("stg_metabric_patient"), stg("stg_tcga_patient"), concept_map
            )
        if table == "visit_occurrence":
            return clinical.visit_rows(stg("stg_synthea_encounters"), self.person_keys)
        if table == "condition_occurrence":
            return clinical.condition_rows(
                stg("stg_synthea_conditions"),
                stg("stg_metabric_sample"),
                stg("stg_tcga_sample"),
                self.person_keys,
                self.codes("SNOMED"),
                concept_map,
            )
        if table == "drug_exposure":
            return clinical.drug_rows(stg("stg_synthea_medications"), self.person_keys, self.codes("RxNorm"))
        if table == "procedure_occurrence":
            return clinical.procedure_rows(stg("stg_synthea_procedures"), self.person_keys, self.codes("SNOMED"))
        if table == "measurement":
            return clinical.measurement_rows(
                stg("stg_synthea_observations"),
                stg("stg_metabric_sample"),
                self.person_keys,
                self.codes("LOINC", standard_only=False),
                concept_map,
            )
        if table == "observation":
            return clinical.observation_rows(
                stg("stg_metabric_patient"),
                stg("stg_metabric_sample"),
                stg("stg_tcga_patient"),
                self.person_keys,
                concept_map,
            )
        if table == "observation_period" and all(fact in self.written for fact in clinical.DATED_FACTS):
            return clinical.observation_period_of({fact: self.written[fact] for fact in clinical.DATED_FACTS})
        if table == "observation_period":
            return clinical.observation_period_rows(
                stg("stg_synthea_encounters"),
                stg("stg_synthea_conditions"),
                stg("stg_synthea_observations"),
                stg("stg_synthea_medications"),
                stg("stg_synthea_procedures"),
                self.person_keys,
            )
        if table == "death":
            return clinical.death(stg("stg_synthea_patients"), self.person_keys)
        raise KeyError(table)

    def table(self, name: str) -> DataFrame:
        if name not in self._done:
            self._done[name] = self._model(name)
        return self._done[name]

    def _model(self, name: str) -> DataFrame:
        if name == "person":
            return self.person
        if name == "death":
            return self.rows("death")
        if name in NUMBERED:
            return NUMBERED[name](self.rows(name))
        if name in ("metabric_mutations", "tcga_brca_mutations"):
            return genomic.raw_mutations(self.raw[name.replace("mutations", "_data_mutations")])
        if name == "sample_person":
            return genomic.sample_person(
                self.staging("stg_metabric_sample"), self.staging("stg_tcga_sample"), self.person
            )
        if name == "person_deid":
            return deid.person_deid(self.person, self.as_of_year)
        if name == "mutations_deid":
            linked = deid.linked_samples(self.table("sample_person"))
            if "sample_person" not in self.written:
                linked = _kept(linked, "linked_samples")  # measured and then joined
            linked = broadcast_if_small(linked, self.broadcast_bytes)
            return deid.mutations_deid(self.table("metabric_mutations"), self.table("tcga_brca_mutations"), linked)
        if name in PROJECTED:
            source, project = PROJECTED[name]
            return project(self.table(source))
        if name == "unique_patients":
            return deid.unique_patients(
                self.table("person_deid"), self.table("condition_occurrence_deid"), self.table("mutations_deid")
            )
        raise KeyError(name)


# Clinical tables that get a surrogate id.
NUMBERED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "visit_occurrence": clinical.visit_occurrence,
    "condition_occurrence": clinical.condition_occurrence,
    "drug_exposure": clinical.drug_exposure,
    "procedure_occurrence": clinical.procedure_occurrence,
    "measurement": clinical.measurement,
    "observation": clinical.observation,
    "observation_period": clinical.observation_period,
}
# De-identified tables that are a projection of one clinical table.
PROJECTED: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "condition_occurrence_deid": ("condition_occurrence", deid.condition_occurrence_deid),
    "measurement_deid": ("measurement", deid.measurement_deid),
    "observation_deid": ("observation", deid.observation_deid),
    "visit_occurrence_deid": ("visit_occurrence", deid.visit_occurrence_deid),
    "drug_exposure_deid": ("drug_exposure", deid.drug_exposure_deid),
    "procedure_occurrence_deid": ("procedure_occurrence", deid.procedure_occurrence_deid),
    "observation_period_deid": ("observation_period", deid.observation_period_deid),
}
CLINICAL = ["person", *NUMBERED, "death"]
GENOMIC = ["metabric_mutations", "tcga_brca_mutations", "sample_person"]
ANALYTICS = ["person_deid", *PROJECTED, "mutations_deid", "unique_patients"]
TABLE_LAYERS = {"omop": CLINICAL, "genomic": GENOMIC, "analytics": ANALYTICS}
# What can be written at the same time: tables of a step are made from those of the steps before it and from raw tables.
LATER = ("observation_period", "unique_patients")
STEPS = [
    [*[t for t in CLINICAL if t not in LATER], "metabric_mutations", "tcga_brca_mutations"],
    ["observation_period", "sample_person"],
    [t for t in ANALYTICS if t not in LATER],
    ["unique_patients"],
]


def build(layers: Layers, prefix: str = "", location: str | None = None, threads: int = 6) -> dict[str, DataFrame]:
    """Materialises every layer and returns the tables as written.

    Staging becomes temporary views; the other layers become tables in the databases ``<prefix>omop``,
    ``<prefix>genomic`` and ``<prefix>analytics``. Each layer reads the previous one as written, so no model is computed
    twice. Tables that do not depend on each other are written from a few driver threads, the raw variant tables, which need
    no other, along with the clinical ones; observation periods and the roster follow the tables they are made from.
    """
    for view in staging.VIEWS:
        layers.staging(view).createOrReplaceTempView(f"{prefix}{view}")
    layers.person_keys  # noqa: B018 - every other model joins it, so it is written before the threads start
    layers.codes("SNOMED")
    databases = {name: f"{prefix}{layer}" for layer, names in TABLE_LAYERS.items() for name in names}

    def write(name: str) -> None:
        layers._done[name] = layers.written[name] = save_table(layers.table(name), databases[name], name, location)

    with ThreadPoolExecutor(threads) as pool:
        for names in STEPS:
            for done in [pool.submit(copy_context().run, write, n) for n in names]:
                done.result()
    return dict(layers.written)
