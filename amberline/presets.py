"""Domain constants of the road-risk rating: catalogs, rules, bins, weights, defaults.

Everything here is a fixed value that results depend on.  The operators take
these as parameters and hold no domain constants of their own.
"""

from __future__ import annotations

# --- fixed values: catalogs -------------------------------------------------
REGIONS = ["Lima", "Arequipa", "Cusco", "La Libertad", "Piura", "Cajamarca", "Junín", "Puno",
           "Loreto", "Ancash", "Ica", "Lambayeque", "Tacna", "Huánuco", "Apurímac"]
ROAD_TYPES = ["Nacional", "Departamental", "Secundaria", "Urbana"]
VEHICLE_TYPES = ["Automóvil", "Camioneta", "Camión", "Bus", "Moto", "Semirremolque"]
CAUSES = ["Exceso de velocidad", "Falla mecánica", "Fatiga del conductor",
          "Lluvia / visibilidad reducida", "Invasión de carril", "Curva peligrosa",
          "Alcohol", "Distracción", "Neblina"]
TIME_SLOTS = ["Madrugada (00-06)", "Mañana (06-12)", "Tarde (12-18)", "Noche (18-24)"]
DENSITIES = ["Baja", "Media", "Alta"]
SEASONS = ["Verano", "Otoño", "Invierno", "Primavera"]
ENGINE_SIZES = [1000, 1300, 1600, 2000, 2400, 3000, 4500]
TIERS = ["BAJO", "MEDIO", "ALTO"]

# --- fixed values: draw probabilities ---------------------------------------
TIME_SLOT_P = [0.15, 0.30, 0.35, 0.20]
REGION_P = [0.25, 0.08, 0.07, 0.07, 0.07, 0.06, 0.06, 0.06, 0.05, 0.05, 0.05, 0.04, 0.03, 0.03, 0.03]
ROAD_TYPE_P = [0.40, 0.25, 0.20, 0.15]
VEHICLE_TYPE_P = [0.30, 0.20, 0.18, 0.12, 0.12, 0.08]
DENSITY_P = [0.30, 0.45, 0.25]
DEATHS = [0, 1, 2, 3, 4]
DEATHS_P = [0.72, 0.15, 0.08, 0.03, 0.02]
FIRST_DATE = "2022-01-01"
STEP_HOURS = 8

# --- fixed values: tiers, rule scorecard, season map ------------------------
TIER_EDGES = [0, 33, 66, 100]
ROAD_TYPE_POINTS = {"Nacional": 5, "Departamental": 8, "Secundaria": 12, "Urbana": 6}
VEHICLE_TYPE_POINTS = {"Automóvil": 3, "Camioneta": 5, "Camión": 9, "Bus": 8, "Moto": 7,
                       "Semirremolque": 10}
NIGHT_MARKERS = ["Noche", "Madrugada"]
NIGHT_POINTS = 8
SCORE_NOISE_SD = 3.0
OLD_VEHICLE_YEARS = 10
MONTH_TO_SEASON = {12: "Verano", 1: "Verano", 2: "Verano", 3: "Otoño", 4: "Otoño", 5: "Otoño",
                   6: "Invierno", 7: "Invierno", 8: "Invierno",
                   9: "Primavera", 10: "Primavera", 11: "Primavera"}
SERVING_MAX_RAIN = 300.0
SERVING_MAX_VISIBILITY = 20.0

# --- fixed values: dirt ------------------------------------------------------
NULLABLE_COLUMNS = ["lluvia_mm", "visibilidad_km", "flujo_vehicular", "edad_conductor",
                    "experiencia_anios", "temperatura_c"]
NULL_RATE = 0.08
OUTLIERS = [("edad_conductor", [5, 150, 200, -1]), ("lluvia_mm", [9999, -50, 5000]),
            ("flujo_vehicular", [-100, 99999, 0]), ("pago_seguro_sol", [-1])]
OUTLIERS_PER_COLUMN = 20
BAD_DATES = ["31/13/2024", "2024-99-01", "no-date", "  2024/01/01  "]
BAD_DATE_ROWS = 50
COPIED_ROWS = 50

# --- fixed values: cleaning --------------------------------------------------
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd"]
RANGE_RULES = {"edad_conductor": (18, 85), "lluvia_mm": (0, 500), "flujo_vehicular": (0, 50000)}
FLOOR_RULES = {"pago_seguro_sol": (0, 0)}

# --- fixed values: features --------------------------------------------------
ENCODED_COLUMNS = ["tipo_via", "tipo_vehiculo", "densidad_via", "region", "estacion", "franja_horaria"]
SERVING_CATALOGS = {"tipo_via": ROAD_TYPES, "tipo_vehiculo": VEHICLE_TYPES, "densidad_via": DENSITIES,
                    "region": REGIONS, "estacion": SEASONS, "franja_horaria": TIME_SLOTS}
FEATURES = ["lluvia_mm", "visibilidad_km", "flujo_vehicular", "edad_conductor", "experiencia_anios",
            "infracciones_prev", "antiguedad_veh", "temperatura_c", "km_ruta", "es_horario_riesgo",
            "indice_clima_peligro", "ratio_exp_edad", "vehiculo_antiguo", "tipo_via_cod",
            "tipo_vehiculo_cod", "densidad_via_cod", "region_cod", "estacion_cod", "franja_horaria_cod"]
TARGET = "nivel_riesgo"

# --- fixed values: model settings -------------------------------------------
LOGISTIC = {"maxIter": 1000, "C": 1.0}
FOREST = {"numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 5}
BOOSTED_WEIGHTED = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8,
                    "featureSubsetStrategy": "0.8", "minInstancesPerNode": 3, "minInfoGain": 1e-4}
BOOSTED_PLAIN = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8,
                 "featureSubsetStrategy": "0.8"}
GRID = {"stepSize": [0.05, 0.1], "maxDepth": [4, 6], "maxIter": [200, 300], "subsamplingRate": [0.8, 1.0]}
TEST_SHARE = 0.20
SPLIT_SEED = 42
CV_FOLDS = 5
GRID_FOLDS = 3

# --- fixed values: probability score and request defaults --------------------
TIER_WEIGHTS = {"ALTO": 60.0, "MEDIO": 30.0, "BAJO": 10.0}
REQUEST_DEFAULTS = {
    "lluvia_mm": 20.0, "visibilidad_km": 10.0, "flujo_vehicular": 3000.0, "edad_conductor": 35.0,
    "experiencia_anios": 10.0, "infracciones_prev": 1, "antiguedad_veh": 5, "temperatura_c": 18.0,
    "km_ruta": 100.0, "tipo_via": "Nacional", "tipo_vehiculo": "Camión", "densidad_via": "Media",
    "region": "Lima", "estacion": "Verano", "franja_horaria": "Tarde (12-18)",
}
TIER_EMOJI = {"ALTO": "🔴", "MEDIO": "🟡", "BAJO": "🟢"}
TIER_ADVICE = {
    "ALTO": "⚠️ INTERVENCIÓN INMEDIATA: Activar protocolo de riesgo alto",
    "MEDIO": "👁️ MONITOREO ACTIVO: Revisar en las próximas 48h",
    "BAJO": "✅ NORMAL: Seguimiento estándar mensual",
}
ROUTE_COLUMNS = ["ruta_id", "region", "tipo_via", "tipo_vehiculo", "lluvia_mm", "score_riesgo",
                 "nivel_riesgo", "proba_ALTO"]
EMPTY_TIER_NOTE = "No hay rutas clasificadas como {tier} en este scoring."

# --- fixed values: names of the published columns and tables ---
FOREST_PREDICTION = "y_pred_rf"
BOOSTED_PREDICTION = "y_pred_xgb"
BOOSTED_PROBABILITY = "proba_xgb_"


# --- fixed values: draws of the two made-up tables ---
def accident_spec():
    """Column draws of the accident table, as ``(name, kind, *args)``."""
    return [
        ("franja_horaria", "weighted", TIME_SLOTS, TIME_SLOT_P),
        ("mes", "integer", 1, 13),
        ("region", "weighted", REGIONS, REGION_P),
        ("tipo_via", "weighted", ROAD_TYPES, ROAD_TYPE_P),
        ("km_ruta", "real", 1, 850, 1),
        ("tipo_vehiculo", "weighted", VEHICLE_TYPES, VEHICLE_TYPE_P),
        ("antiguedad_veh", "integer", 0, 25),
        ("cilindrada_cc", "choice", ENGINE_SIZES),
        ("edad_conductor", "integer", 18, 75),
        ("experiencia_anios", "integer", 0, 40),
        ("infracciones_prev", "poisson", 1.2),
        ("lluvia_mm", "folded_normal", 25, 40, 1),
        ("visibilidad_km", "clipped_normal", 12, 5, 0.5, 20, 1),
        ("temperatura_c", "normal", 18, 8, 1),
        ("flujo_vehicular", "integer", 50, 12000),
        ("densidad_via", "weighted", DENSITIES, DENSITY_P),
        ("causa_principal", "choice", CAUSES),
        ("fallecidos", "weighted", DEATHS, DEATHS_P),
        ("heridos", "poisson", 2.1),
        ("dano_vehiculo_sol", "lognormal", 9, 1.2, 0),
        ("pago_seguro_sol", "lognormal", 9.5, 1.0, 0),
    ]


def route_spec():
    """Column draws of the route table that is scored, as ``(name, kind, *args)``."""
    return [
        ("region", "choice", REGIONS),
        ("tipo_via", "weighted", ROAD_TYPES, ROAD_TYPE_P),
        ("tipo_vehiculo", "choice", VEHICLE_TYPES),
        ("franja_horaria", "choice", TIME_SLOTS),
        ("densidad_via", "weighted", DENSITIES, DENSITY_P),
        ("estacion", "choice", SEASONS),
        ("lluvia_mm", "folded_normal", 30, 45, 1),
        ("visibilidad_km", "clipped_normal", 10, 5, 0.5, 20, 1),
        ("flujo_vehicular", "integer", 100, 10000),
        ("edad_conductor", "integer", 22, 65),
        ("experiencia_anios", "integer", 1, 35),
        ("infracciones_prev", "poisson", 1.0),
        ("antiguedad_veh", "integer", 0, 20),
        ("temperatura_c", "normal", 18, 8, 1),
        ("km_ruta", "real", 5, 500, 1),
        ("mes", "integer", 1, 13),
    ]
