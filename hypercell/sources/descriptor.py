"""Table descriptors: declared columns as dictionaries, the schema they stand for, and those of MeasurementSet tables."""

from __future__ import annotations

import copy
import re

from pyspark.sql import types as T

from hypercell.errors import InvalidTable
from hypercell.functions.types import cell_type, depth_of, nested, of_spark

ROW = "__row__"
TABLE_KEYS = ("_define_hypercolumn_", "_keywords_", "_private_keywords_")

# Columns of the tables of MeasurementSet version 2: name, value type, then rank (2d) or fixed shape ([3]), unit and
# measure (type:frame); "-" ends the required ones. Fixed values of the public format.
_SPECS = {
    "MAIN": "ANTENNA1 int; ANTENNA2 int; ARRAY_ID int; DATA_DESC_ID int; EXPOSURE double s; FEED1 int; FEED2 int; FIELD_ID int; FLAG boolean 2d; FLAG_CATEGORY boolean 3d; FLAG_ROW boolean; INTERVAL double s; OBSERVATION_ID int; PROCESSOR_ID int; SCAN_NUMBER int; SIGMA float 1d; STATE_ID int; TIME double s epoch:UTC; TIME_CENTROID double s epoch:UTC; UVW double [3] m uvw:ITRF; WEIGHT float 1d; -; CORRECTED_DATA complex 2d; DATA complex 2d; FLOAT_DATA float 2d; MODEL_DATA complex 2d; SIGMA_SPECTRUM float 2d; WEIGHT_SPECTRUM float 2d",
    "ANTENNA": "DISH_DIAMETER double m; FLAG_ROW boolean; MOUNT string; NAME string; OFFSET double [3] m position:ITRF; POSITION double [3] m position:ITRF; STATION string; TYPE string; -; ORBIT_ID int; PHASED_ARRAY_ID int",
    "DATA_DESCRIPTION": "FLAG_ROW boolean; POLARIZATION_ID int; SPECTRAL_WINDOW_ID int; -; LAG_ID int",
    "DOPPLER": "DOPPLER_ID int; SOURCE_ID int; TRANSITION_ID int; VELDEF double m/s doppler:RADIO",
    "FEED": "ANTENNA_ID int; BEAM_ID int; BEAM_OFFSET double 2d rad direction:J2000; FEED_ID int; INTERVAL double s; NUM_RECEPTORS int; POLARIZATION_TYPE string 1d; POL_RESPONSE complex 2d; POSITION double [3] m position:ITRF; RECEPTOR_ANGLE double 1d rad; SPECTRAL_WINDOW_ID int; TIME double s epoch:UTC; -; FOCUS_LENGTH double m; PHASED_FEED_ID int",
    "FIELD": "CODE string; DELAY_DIR double 2d rad direction:J2000; FLAG_ROW boolean; NAME string; NUM_POLY int; PHASE_DIR double 2d rad direction:J2000; REFERENCE_DIR double 2d rad direction:J2000; SOURCE_ID int; TIME double s epoch:UTC; -; EPHEMERIS_ID int",
    "FLAG_CMD": "APPLIED boolean; COMMAND string; INTERVAL double s; LEVEL int; REASON string; SEVERITY int; TIME double s epoch:UTC; TYPE string",
    "FREQ_OFFSET": "ANTENNA1 int; ANTENNA2 int; FEED_ID int; INTERVAL double s; OFFSET double Hz; SPECTRAL_WINDOW_ID int; TIME double s epoch:UTC",
    "HISTORY": "APPLICATION string; APP_PARAMS string 1d; CLI_COMMAND string 1d; MESSAGE string; OBJECT_ID int; OBSERVATION_ID int; ORIGIN string; PRIORITY string; TIME double s epoch:UTC",
    "OBSERVATION": "FLAG_ROW boolean; LOG string 1d; OBSERVER string; PROJECT string; RELEASE_DATE double s epoch:UTC; SCHEDULE string 1d; SCHEDULE_TYPE string; TELESCOPE_NAME string; TIME_RANGE double [2] s epoch:UTC",
    "POINTING": "ANTENNA_ID int; DIRECTION double 2d rad direction:J2000; INTERVAL double s; NAME string; NUM_POLY int; TARGET double 2d rad direction:J2000; TIME double s epoch:UTC; TIME_ORIGIN double s epoch:UTC; TRACKING boolean; -; ENCODER double [2] rad direction:J2000; ON_SOURCE boolean; OVER_THE_TOP boolean; POINTING_MODEL_ID int; POINTING_OFFSET double 2d rad direction:J2000; SOURCE_OFFSET double 2d rad direction:J2000",
    "POLARIZATION": "CORR_PRODUCT int 2d; CORR_TYPE int 1d; FLAG_ROW boolean; NUM_CORR int",
    "PROCESSOR": "FLAG_ROW boolean; MODE_ID int; SUB_TYPE string; TYPE string; TYPE_ID int; -; PASS_ID int",
    "SOURCE": "CALIBRATION_GROUP int; CODE string; DIRECTION double [2] rad direction:J2000; INTERVAL double s; NAME string; NUM_LINES int; PROPER_MOTION double [2] rad/s; SOURCE_ID int; SPECTRAL_WINDOW_ID int; TIME double s epoch:UTC; -; POSITION double [3] m position:ITRF; PULSAR_ID int; REST_FREQUENCY double 1d Hz frequency:LSRK; SYSVEL double 1d m/s radialvelocity:LSRK; TRANSITION string 1d",
    "SPECTRAL_WINDOW": "CHAN_FREQ double 1d Hz frequency:TOPO; CHAN_WIDTH double 1d Hz; EFFECTIVE_BW double 1d Hz; FLAG_ROW boolean; FREQ_GROUP int; FREQ_GROUP_NAME string; IF_CONV_CHAIN int; MEAS_FREQ_REF int; NAME string; NET_SIDEBAND int; NUM_CHAN int; REF_FREQUENCY double Hz frequency:TOPO; RESOLUTION double 1d Hz; TOTAL_BANDWIDTH double Hz; -; ASSOC_NATURE string 1d; ASSOC_SPW_ID int 1d; BBC_NO int; BBC_SIDEBAND int; DOPPLER_ID int; RECEIVER_ID int",
    "STATE": "CAL double K; FLAG_ROW boolean; LOAD double K; OBS_MODE string; REF boolean; SIG boolean; SUB_SCAN int",
    "SYSCAL": "ANTENNA_ID int; FEED_ID int; INTERVAL double s; SPECTRAL_WINDOW_ID int; TIME double s epoch:UTC; -; PHASE_DIFF float rad; PHASE_DIFF_FLAG boolean; TANT float 1d K; TANT_FLAG boolean; TCAL float 1d K; TCAL_FLAG boolean; TRX float 1d K; TRX_FLAG boolean; TSKY float 1d K; TSKY_FLAG boolean; TSYS float 1d K; TSYS_FLAG boolean",
    "WEATHER": "ANTENNA_ID int; INTERVAL double s; TIME double s epoch:UTC; -; DEW_POINT float K; DEW_POINT_FLAG boolean; H2O float m-2; H2O_FLAG boolean; IONOS_ELECTRON float m-2; IONOS_ELECTRON_FLAG boolean; PRESSURE float hPa; PRESSURE_FLAG boolean; REL_HUMIDITY float %; REL_HUMIDITY_FLAG boolean; TEMPERATURE float K; TEMPERATURE_FLAG boolean; WIND_DIRECTION float rad; WIND_DIRECTION_FLAG boolean; WIND_SPEED float m/s; WIND_SPEED_FLAG boolean",
}

SUBTABLES = tuple(sorted(k for k in _SPECS if k != "MAIN"))
# Created with a new main table.
DEFAULT_SUBTABLES = ("ANTENNA", "DATA_DESCRIPTION", "FEED", "FIELD", "FLAG_CMD", "HISTORY", "OBSERVATION", "POINTING", "POLARIZATION", "PROCESSOR", "SPECTRAL_WINDOW", "STATE")


def column(value_type: str, ndim: int | None = None, shape: list[int] | None = None, comment: str = "", keywords: dict | None = None) -> dict:
    """A column's descriptor. No ``ndim``: scalar; -1: any rank; a ``shape`` (C order) makes it fixed."""
    cell_type(value_type)
    out = {"comment": comment, "dataManagerGroup": "StandardStMan", "dataManagerType": "StandardStMan", "keywords": keywords or {}, "maxlen": 0, "option": 0, "valueType": value_type}
    if shape is not None:
        ndim = len(shape)
        out |= {"shape": list(shape), "option": 5}
    if ndim is not None:
        out["ndim"] = ndim
    return out


def _parse(spec: str) -> tuple[str, dict]:
    name, kind, *more = spec.split()
    ndim = shape = None
    keywords: dict = {}
    for m in more:
        if re.fullmatch(r"\dd", m):
            ndim = int(m[0])
        elif m.startswith("["):
            shape = [int(x) for x in m[1:-1].split(",")]
        elif ":" in m:
            kind_, frame = m.split(":")
            keywords["MEASINFO"] = {"Ref": frame, "type": kind_}
        else:
            keywords["QuantumUnits"] = [m] * (shape[0] if shape and len(shape) == 1 else 1)
    return name, column(kind, ndim, shape, name.replace("_", " ").lower(), keywords)


def ms_descriptor(table: str, complete: bool = False) -> dict:
    """Descriptor of the MAIN table or a subtable, with the required columns only or with the optional ones."""
    try:
        spec = _SPECS[table.upper()]
    except KeyError:
        raise InvalidTable(f"there is no MeasurementSet table {table}") from None
    needed, _, more = spec.partition("; -; ")
    text = f"{needed}; {more}" if complete and more else needed
    return dict(_parse(s.strip()) for s in text.split(";") if s.strip()) | {k: {} for k in TABLE_KEYS}


def merged(required: dict, own: dict | None) -> dict:
    """The required descriptor with the user's columns and keywords over it."""
    out = copy.deepcopy(required)
    for k, v in (own or {}).items():
        if k in TABLE_KEYS:
            out.setdefault(k, {}).update(copy.deepcopy(v))
        else:
            out[k] = copy.deepcopy(v)
    return out


def columns(desc: dict) -> list[str]:
    return sorted(k for k in desc if not (k.startswith("_") and k.endswith("_")))


def is_flat(col: dict) -> bool:
    """Cells of any rank are held as a shape and flat data."""
    return col.get("ndim") == -1


def depth(col: dict) -> int:
    """Array levels of the held cell, with the pair of a complex number."""
    return max(0, col.get("ndim") or 0) + cell_type(col["valueType"]).is_complex


def field(name: str, col: dict) -> T.StructField:
    kind = cell_type(col["valueType"])
    if is_flat(col):
        spark = T.StructType([T.StructField("shape", T.ArrayType(T.IntegerType())), T.StructField("data", nested(kind.spark, 1 + kind.is_complex))])
    else:
        spark = nested(kind.spark, depth(col))
    return T.StructField(name, spark, True, {"descriptor": col, "complex": kind.is_complex})


def schema(desc: dict) -> T.StructType:
    return T.StructType([T.StructField(ROW, T.LongType(), False), *(field(c, desc[c]) for c in columns(desc))])


def of_schema(struct: T.StructType) -> dict:
    """A descriptor for a DataFrame's columns; arrays count as variably shaped. A field's own descriptor wins."""
    out: dict = {}
    for f in struct.fields:
        if f.name == ROW:
            continue
        if "descriptor" in (f.metadata or {}):
            out[f.name] = f.metadata["descriptor"]
            continue
        n, kind = depth_of(f.dataType)
        out[f.name] = column(of_spark(kind).name, n or None)
    return out | {k: {} for k in TABLE_KEYS}
