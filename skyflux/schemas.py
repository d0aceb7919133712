"""Schemas, band list and photometry flag masks."""

from pyspark.sql import types as T

# Fixed values of the survey data model.
BANDS = ["u", "g", "r", "i", "z", "Y"]
PHOTFLAG_SATURATE = 0x400
PHOTFLAG_TRIGGER = 0x800
PHOTFLAG_DETECT = 0x1000
SEPARATOR_MJD = -777.0
SEPARATOR_SNID = -999

# HEAD columns dropped as uninformative by the bulk reader.
HEAD_DROP_COLUMNS = ["IAUC", "FAKE", "PIXSIZE", "NXPIX", "NYPIX", "SEARCH_TYPE"]

# Photometry columns kept from a PHOT file, in file order.
PHOT_COLUMNS = ["MJD", "BAND", "PHOTFLAG", "PHOTPROB", "FLUXCAL", "FLUXCALERR",
                "PSF_SIG1", "SKY_SIG", "RDNOISE", "ZEROPT", "ZEROPT_ERR", "GAIN",
                "SIM_MAGOBS"]

PHOT_SCHEMA = T.StructType([
    T.StructField("row_idx", T.LongType(), False),
    T.StructField("MJD", T.DoubleType()),
    T.StructField("BAND", T.StringType()),
    T.StructField("PHOTFLAG", T.IntegerType()),
    T.StructField("PHOTPROB", T.FloatType()),
    T.StructField("FLUXCAL", T.FloatType()),
    T.StructField("FLUXCALERR", T.FloatType()),
    T.StructField("PSF_SIG1", T.FloatType()),
    T.StructField("SKY_SIG", T.FloatType()),
    T.StructField("RDNOISE", T.FloatType()),
    T.StructField("ZEROPT", T.FloatType()),
    T.StructField("ZEROPT_ERR", T.FloatType()),
    T.StructField("GAIN", T.FloatType()),
    T.StructField("SIM_MAGOBS", T.FloatType()),
])

SOURCE_TRUTH_SCHEMA = T.StructType([
    T.StructField("SourceID", T.LongType()),
    T.StructField("SNID", T.LongType()),
    T.StructField("MJD", T.DoubleType()),
    T.StructField("DETECT", T.IntegerType()),
    T.StructField("TRUE_GENTYPE", T.IntegerType()),
    T.StructField("TRUE_GENMAG", T.DoubleType()),
])

DIA_SOURCE = T.StructType([
    T.StructField("diaSourceId", T.LongType(), False),
    T.StructField("diaObjectId", T.LongType()),
    T.StructField("midPointTai", T.DoubleType()),
    T.StructField("filterName", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("decl", T.DoubleType()),
    T.StructField("psFlux", T.FloatType()),
    T.StructField("psFluxErr", T.FloatType()),
    T.StructField("snr", T.FloatType()),
])

DIA_FORCED_SOURCE = T.StructType([
    T.StructField("diaForcedSourceId", T.LongType(), False),
    T.StructField("diaObjectId", T.LongType()),
    T.StructField("midPointTai", T.DoubleType()),
    T.StructField("filterName", T.StringType()),
    T.StructField("psFlux", T.FloatType()),
    T.StructField("psFluxErr", T.FloatType()),
])

DIA_OBJECT = T.StructType([
    T.StructField("diaObjectId", T.LongType(), False),
    T.StructField("simVersion", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("decl", T.DoubleType()),
    T.StructField("mwebv", T.FloatType()),
    T.StructField("mwebv_err", T.FloatType()),
    T.StructField("z_final", T.FloatType()),
    T.StructField("z_final_err", T.FloatType()),
])

ALERT = T.StructType([
    T.StructField("alertId", T.LongType(), False),
    T.StructField("diaSource", DIA_SOURCE),
    T.StructField("prvDiaSources", T.ArrayType(DIA_SOURCE)),
    T.StructField("prvDiaForcedSources", T.ArrayType(DIA_FORCED_SOURCE)),
    T.StructField("diaObject", DIA_OBJECT),
])

CLASSIFICATION = T.StructType([
    T.StructField("classId", T.IntegerType(), False),
    T.StructField("probability", T.FloatType(), False),
])

BROKER_MESSAGE = T.StructType([
    T.StructField("alertId", T.LongType(), False),
    T.StructField("diaSourceId", T.LongType(), False),
    T.StructField("publishTimestamp", T.TimestampType()),
    T.StructField("brokerIngestTimestamp", T.TimestampType()),
    T.StructField("brokerName", T.StringType()),
    T.StructField("brokerVersion", T.StringType()),
    T.StructField("classifierName", T.StringType()),
    T.StructField("classifierParams", T.StringType()),
    T.StructField("classifications", T.ArrayType(CLASSIFICATION)),
])

TEMPLATE_PARAMS = T.StructType([
    T.StructField("VK", T.DoubleType()),
    T.StructField("LOGXLAN", T.DoubleType()),
    T.StructField("LOGMASS", T.DoubleType()),
])
