"""Domain parameters.  Every operator takes a ``Settings`` and defaults to ``DEFAULTS``."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Column names of the source data set, its valid states, and names of the derived columns.
RAW_COLUMNS = (
    "nivel_entidad",
    "codigo_entidad_en_secop",
    "nombre_de_la_entidad",
    "nit_de_la_entidad",
    "departamento_entidad",
    "municipio_entidad",
    "estado_del_proceso",
    "modalidad_de_contrataci_n",
    "objeto_a_contratar",
    "objeto_del_proceso",
    "tipo_de_contrato",
    "fecha_de_firma_del_contrato",
    "fecha_inicio_ejecuci_n",
    "fecha_fin_ejecuci_n",
    "numero_del_contrato",
    "numero_de_proceso",
    "valor_contrato",
    "nom_raz_social_contratista",
    "url_contrato",
    "origen",
    "tipo_documento_proveedor",
    "documento_proveedor",
)
VALID_STATES = (
    "celebrado",
    "adjudicado",
    "en ejecución",
    "liquidado",
    "terminado",
    "terminado sin liquidar",
    "modificado",
    "cerrado",
)
RENAMES = {
    "modalidad_de_contrataci_n": "modalidad_de_contratacion",
    "fecha_inicio_ejecuci_n": "fecha_inicio_ejecucion",
    "fecha_fin_ejecuci_n": "fecha_fin_ejecucion",
}
IDENTIFIERS = ("numero_del_contrato", "url_contrato", "objeto_a_contratar")
NUMERIC = (
    "valor_contrato",
    "valor_vs_promedio_categoria",
    "duracion_dias",
    "mes_firma",
    "dia_semana_firma",
    "concentracion_proveedor",
)
CATEGORICAL = (
    "modalidad_de_contratacion",
    "departamento_entidad",
    "nivel_entidad",
    "tipo_de_contrato",
    "origen",
    "tipo_documento_proveedor",
)
FEATURE_COLUMNS = (
    "numero_del_contrato",
    "url_contrato",
    "objeto_a_contratar",
    "documento_proveedor",
    "departamento_entidad",
    "nivel_entidad",
    "tipo_de_contrato",
    "origen",
    "tipo_documento_proveedor",
    "valor_contrato",
    "fecha_de_firma_del_contrato",
    "valor_vs_promedio_categoria",
    "duracion_dias",
    "mes_firma",
    "dia_semana_firma",
    "concentracion_proveedor",
    "modalidad_de_contratacion",
    "fecha_inicio_ejecucion",
    "fecha_fin_ejecucion",
)

SIGN_DATE = "fecha_de_firma_del_contrato"
START_DATE = "fecha_inicio_ejecuci_n"
END_DATE = "fecha_fin_ejecuci_n"
SUPPLIER = "documento_proveedor"
#: Derived key which may be listed in ``category_keys`` to compare within the signing year only.
SIGN_YEAR = "anio_firma"


@dataclass(frozen=True)
class Settings:
    # incremental extract
    history_start: str = "2022-01-01"
    window_days: int = 15
    overlap_days: int = 5
    # business filter
    valid_states: tuple[str, ...] = VALID_STATES
    value_min: float = 1_000_000
    value_max: float = 200_000_000
    # comparison group of ``valor_vs_promedio_categoria``, raw names
    category_keys: tuple[str, ...] = ("modalidad_de_contrataci_n", "departamento_entidad")
    # model
    n_trees: int = 500
    max_samples: int | float | str = "auto"
    max_features: float = 1.0
    contamination: float | str = "auto"
    seed: int = 42
    # tuning
    #: All rows unless a sample is asked for.
    tuning_rows: int | None = None
    synthetic_rows: int = 150
    n_trials: int = 40
    top_fraction: float = 0.01
    examples: int = 20
    # drift
    reference_years: tuple[int, ...] = (2023,)
    current_years: tuple[int, ...] = (2025, 2026)
    #: ``distances`` or ``tests``; never chosen by the size of the data.
    drift_method: str = "distances"
    low_cardinality: int = 5
    # size of the sketches that estimate numeric drift; None computes it from all distinct values
    drift_sketch_k: int | None = None
    p_value_threshold: float = 0.05
    distance_threshold: float = 0.1
    drift_share: float = 0.5
    # retrain signals
    growth_share: float = 0.05
    rate_change_pct: float = 30.0
    # sizes up to which a lookup side is broadcast / an index is accepted
    broadcast_rows: int = 1_000_000
    max_categories: int = 100_000

    def with_(self, **changes) -> Settings:
        return replace(self, **changes)

    @property
    def feature_category_keys(self) -> tuple[str, ...]:
        """Category keys under the names they carry in the features table."""
        return tuple(RENAMES.get(k, k) for k in self.category_keys)


DEFAULTS = Settings()
