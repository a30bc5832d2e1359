"""Schemas of the water-chemistry tables the ready-made plans work on.

The column names and their order are fixed values of the data format.
"""

from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

SAMPLE_COLUMNS = """
    SITE_ID PROGRAM_ID DATE_SMP SAMPLE_LOCATION SAMPLE_TYPE WATERBODY_TYPE SAMPLE_DEPTH
    TIME_SMP ANC_UEQ_L CA_UEQ_L CHL_A_UG_L CL_UEQ_L COND_UM_CM DOC_MG_L F_UEQ_L K_UEQ_L
    MG_UEQ_L NA_UEQ_L NH4_UEQ_L NO3_UEQ_L N_TD_UEQ_L PH_EQ PH_FLD PH_LAB PH_STVL P_TL_UEQ_L
    SECCHI_M SIO2_MG_L SO4_UEQ_L WTEMP_DEG_C
""".split()

SITE_COLUMNS = """
    SITE_ID PROGRAM_ID LATDD LONDD LATDD_CENTROID LONDD_CENTROID SITE_NAME COMID FEATUREID
    COUNTY STATE ECOREGION_I ECOREGION_II ECOREGION_III ECOREGION_IV ECONAME_I ECONAME_II
    ECONAME_III ECONAME_IV LAKE_DEPTH_MAX LAKE_DEPTH_MEAN LAKE_RET LAKE_AREA_HA
    LAKE_AREA_NHD2 WSHD_AREA_HA SITE_ELEV WSHD_ELEV_AVG WSHD_ELEV_MIN WSHD_ELEV_MAX
    WSHD_SLOPE_AVG UPDATE_DATE
""".split()

METHOD_COLUMNS = "PROGRAM_ID PARAMETER START_YEAR END_YEAR METHOD METHOD_DESCRIPTION".split()

# Mean column of the metrics table by the measurement it is taken from.
METRIC_COLUMNS = {"PH_LAB": "AVG_PH", "SO4_UEQ_L": "AVG_SO4", "NO3_UEQ_L": "AVG_NO3"}

SAMPLE_TIMESTAMPS = ("DATE_SMP", "TIME_SMP")
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _text_schema(columns, timestamps=()):
    return StructType(
        [StructField(c, TimestampType() if c in timestamps else StringType()) for c in columns]
    )


SAMPLES = _text_schema(SAMPLE_COLUMNS, SAMPLE_TIMESTAMPS)
SITES = _text_schema(SITE_COLUMNS)
METHODS = _text_schema(METHOD_COLUMNS)


def ledger_schema(date_type=TimestampType()):
    """One row per stored batch; the date type follows the batch's date column."""
    return StructType(
        [
            StructField("version_id", StringType()),
            StructField("min_datestamp", date_type),
            StructField("max_datestamp", date_type),
            StructField("description", StringType()),
            StructField("snapshot_path", StringType()),
            StructField("row_count", LongType()),
            StructField("corrupt_count", LongType()),
        ]
    )


LEDGER = ledger_schema()
