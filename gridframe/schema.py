"""Names, lengths and types of the atmospheric column records."""

from __future__ import annotations

from pyspark.sql import types as T

# Variable names of each family, in the order of the array positions.
FAMILIES = {
    "sca_inputs": [
        "skin_temperature",
        "cos_solar_zenith_angle",
        "sw_albedo_band_0",
        "sw_albedo_band_1",
        "sw_albedo_band_2",
        "sw_albedo_band_3",
        "sw_albedo_band_4",
        "sw_albedo_band_5",
        "sw_albedo_direct_band_0",
        "sw_albedo_direct_band_1",
        "sw_albedo_direct_band_2",
        "sw_albedo_direct_band_3",
        "sw_albedo_direct_band_4",
        "sw_albedo_direct_band_5",
        "lw_emissivity_band_0",
        "lw_emissivity_band_1",
        "solar_irradiance",
    ],
    "col_inputs": [
        "q",
        "o3_mmr",
        "co2_vmr",
        "n2o_vmr",
        "ch4_vmr",
        "o2_vmr",
        "cfc11_vmr",
        "cfc12_vmr",
        "hcfc22_vmr",
        "ccl4_vmr",
        "cloud_fraction",
        "aerosol_mmr_0",
        "aerosol_mmr_1",
        "aerosol_mmr_2",
        "aerosol_mmr_3",
        "aerosol_mmr_4",
        "aerosol_mmr_5",
        "aerosol_mmr_6",
        "aerosol_mmr_7",
        "aerosol_mmr_8",
        "aerosol_mmr_9",
        "aerosol_mmr_10",
        "aerosol_mmr_11",
        "q_liquid",
        "q_ice",
        "re_liquid",
        "re_ice",
    ],
    "hl_inputs": ["temperature_hl", "pressure_hl"],
    "inter_inputs": ["overlap_param"],
}

# Half levels of one column, the output arrays, and the last timestep there is.
HALF_LEVELS = 138
FLUXES = ["flux_dn_sw", "flux_up_sw", "flux_dn_lw", "flux_up_lw"]
HEATING_RATES = ["hr_sw", "hr_lw"]
LAST_TIMESTEP = 3500

# The eight variables that models are built from.
FEATURES = ["sca_inputs", "col_inputs", "hl_inputs", "inter_inputs", *FLUXES]

VECTOR = T.ArrayType(T.FloatType())
MATRIX = T.ArrayType(VECTOR)

COLUMNS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("column_id", T.LongType()),
        T.StructField("sca_inputs", VECTOR),
        T.StructField("col_inputs", MATRIX),
        T.StructField("hl_inputs", MATRIX),
        T.StructField("inter_inputs", MATRIX),
        *[T.StructField(name, VECTOR) for name in FLUXES + HEATING_RATES],
        T.StructField("timestep", T.IntegerType()),
        T.StructField("patch", T.IntegerType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("dataset_len", T.LongType()),
        T.StructField("num_shards", T.LongType()),
        T.StructField("x_shape", T.ArrayType(T.IntegerType())),
        T.StructField("y_shape", T.ArrayType(T.IntegerType())),
        T.StructField("edge_shape", T.ArrayType(T.IntegerType())),
    ]
)

STATS = "array string, pos int, n bigint, mean double, std double"


def variables(family: str) -> list[str]:
    """Names of a family in array order."""
    return list(FAMILIES[family])


def variable_index(family: str, name: str) -> int:
    """Array position of a named variable."""
    return FAMILIES[family].index(name)


def family_of(name: str) -> str:
    """Family that holds a named variable."""
    for family, names in FAMILIES.items():
        if name in names:
            return family
    raise KeyError(name)
