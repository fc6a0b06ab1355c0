"""Record layouts of the STDF V4 format.

The one table that drives decoding, text rendering, field configuration and
coverage. ``register_record_type`` adds a type or redefines one.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The record layouts, in read order. ``xT[N]`` is an array of T
# whose length is the value of the earlier field N.
_LAYOUTS: dict[str, tuple[int, int, str]] = {
    "FAR": (0, 10, "CPU_TYPE:U1 STDF_VER:U1"),
    "ATR": (0, 20, "MOD_TIM:U4 CMD_LINE:Cn"),
    "MIR": (
        1, 10,
        "SETUP_T:U4 START_T:U4 STAT_NUM:U1 MODE_COD:C1 RTST_COD:C1 PROT_COD:C1 BURN_TIM:U2 CMOD_COD:C1 "
        "LOT_ID:Cn PART_TYP:Cn NODE_NAM:Cn TSTR_TYP:Cn JOB_NAM:Cn JOB_REV:Cn SBLOT_ID:Cn OPER_NAM:Cn "
        "EXEC_TYP:Cn EXEC_VER:Cn TEST_COD:Cn TST_TEMP:Cn USER_TXT:Cn AUX_FILE:Cn PKG_TYP:Cn FAMILY_ID:Cn "
        "DATE_COD:Cn FACIL_ID:Cn FLOOR_ID:Cn PROC_ID:Cn OPER_FRQ:Cn SPEC_NAM:Cn SPEC_VER:Cn FLOW_ID:Cn "
        "SETUP_ID:Cn DSGN_REV:Cn ENG_ID:Cn ROM_COD:Cn SERL_NUM:Cn SUPR_NAM:Cn",
    ),
    "MRR": (1, 20, "FINISH_T:U4 DISP_COD:C1 USR_DESC:Cn EXC_DESC:Cn"),
    "PCR": (1, 30, "HEAD_NUM:U1 SITE_NUM:U1 PART_CNT:U4 RTST_CNT:U4 ABRT_CNT:U4 GOOD_CNT:U4 FUNC_CNT:U4"),
    "HBR": (1, 40, "HEAD_NUM:U1 SITE_NUM:U1 HBIN_NUM:U2 HBIN_CNT:U4 HBIN_PF:C1 HBIN_NAM:Cn"),
    "SBR": (1, 50, "HEAD_NUM:U1 SITE_NUM:U1 SBIN_NUM:U2 SBIN_CNT:U4 SBIN_PF:C1 SBIN_NAM:Cn"),
    "PMR": (1, 60, "PMR_INDX:U2 CHAN_TYP:U2 CHAN_NAM:Cn PHY_NAM:Cn LOG_NAM:Cn HEAD_NUM:U1 SITE_NUM:U1"),
    "PGR": (1, 62, "GRP_INDX:U2 GRP_NAM:Cn INDX_CNT:U2 PMR_INDX:xU2[INDX_CNT]"),
    "PLR": (
        1, 63,
        "GRP_CNT:U2 GRP_INDX:xU2[GRP_CNT] GRP_MODE:xU2[GRP_CNT] GRP_RADX:xU1[GRP_CNT] PGM_CHAR:xCn[GRP_CNT] "
        "RTN_CHAR:xCn[GRP_CNT] PGM_CHAL:xCn[GRP_CNT] RTN_CHAL:xCn[GRP_CNT]",
    ),
    "RDR": (1, 70, "NUM_BINS:U2 RTST_BIN:xU2[NUM_BINS]"),
    "SDR": (
        1, 80,
        "HEAD_NUM:U1 SITE_GRP:U1 SITE_CNT:U1 SITE_NUM:xU1[SITE_CNT] HAND_TYP:Cn HAND_ID:Cn CARD_TYP:Cn CARD_ID:Cn "
        "LOAD_TYP:Cn LOAD_ID:Cn DIB_TYP:Cn DIB_ID:Cn CABL_TYP:Cn CABL_ID:Cn CONT_TYP:Cn CONT_ID:Cn LASR_TYP:Cn "
        "LASR_ID:Cn EXTR_TYP:Cn EXTR_ID:Cn",
    ),
    "WIR": (2, 10, "HEAD_NUM:U1 SITE_GRP:U1 START_T:U4 WAFER_ID:Cn"),
    "WRR": (
        2, 20,
        "HEAD_NUM:U1 SITE_GRP:U1 FINISH_T:U4 PART_CNT:U4 RTST_CNT:U4 ABRT_CNT:U4 GOOD_CNT:U4 FUNC_CNT:U4 "
        "WAFER_ID:Cn FABWF_ID:Cn FRAME_ID:Cn MASK_ID:Cn USR_DESC:Cn EXC_DESC:Cn",
    ),
    "WCR": (2, 30, "WAFR_SIZ:R4 DIE_HT:R4 DIE_WID:R4 WF_UNITS:U1 WF_FLAT:C1 CENTER_X:I2 CENTER_Y:I2 POS_X:C1 POS_Y:C1"),
    "PIR": (5, 10, "HEAD_NUM:U1 SITE_NUM:U1"),
    "PRR": (
        5, 20,
        "HEAD_NUM:U1 SITE_NUM:U1 PART_FLG:B1 NUM_TEST:U2 HARD_BIN:U2 SOFT_BIN:U2 X_COORD:I2 Y_COORD:I2 TEST_T:U4 "
        "PART_ID:Cn PART_TXT:Cn PART_FIX:Bn",
    ),
    "TSR": (
        10, 30,
        "HEAD_NUM:U1 SITE_NUM:U1 TEST_TYP:C1 TEST_NUM:U4 EXEC_CNT:U4 FAIL_CNT:U4 ALRM_CNT:U4 TEST_NAM:Cn SEQ_NAME:Cn "
        "TEST_LBL:Cn OPT_FLAG:B1 TEST_TIM:R4 TEST_MIN:R4 TEST_MAX:R4 TST_SUMS:R4 TST_SQRS:R4",
    ),
    "PTR": (
        15, 10,
        "TEST_NUM:U4 HEAD_NUM:U1 SITE_NUM:U1 TEST_FLG:B1 PARM_FLG:B1 RESULT:R4 TEST_TXT:Cn ALARM_ID:Cn OPT_FLAG:B1 "
        "RES_SCAL:I1 LLM_SCAL:I1 HLM_SCAL:I1 LO_LIMIT:R4 HI_LIMIT:R4 UNITS:Cn C_RESFMT:Cn C_LLMFMT:Cn C_HLMFMT:Cn "
        "LO_SPEC:R4 HI_SPEC:R4",
    ),
    "MPR": (
        15, 15,
        "TEST_NUM:U4 HEAD_NUM:U1 SITE_NUM:U1 TEST_FLG:B1 PARM_FLG:B1 RTN_ICNT:U2 RSLT_CNT:U2 RTN_STAT:xN1[RTN_ICNT] "
        "RTN_RSLT:xR4[RSLT_CNT] TEST_TXT:Cn ALARM_ID:Cn OPT_FLAG:B1 RES_SCAL:I1 LLM_SCAL:I1 HLM_SCAL:I1 LO_LIMIT:R4 "
        "HI_LIMIT:R4 START_IN:R4 INCR_IN:R4 RTN_INDX:xU2[RTN_ICNT] UNITS:Cn UNITS_IN:Cn C_RESFMT:Cn C_LLMFMT:Cn "
        "C_HLMFMT:Cn LO_SPEC:R4 HI_SPEC:R4",
    ),
    "FTR": (
        15, 20,
        "TEST_NUM:U4 HEAD_NUM:U1 SITE_NUM:U1 TEST_FLG:B1 OPT_FLAG:B1 CYCL_CNT:U4 REL_VADR:U4 REPT_CNT:U4 NUM_FAIL:U4 "
        "XFAIL_AD:I4 YFAIL_AD:I4 VECT_OFF:I2 RTN_ICNT:U2 PGM_ICNT:U2 RTN_INDX:xU2[RTN_ICNT] RTN_STAT:xN1[RTN_ICNT] "
        "PGM_INDX:xU2[PGM_ICNT] PGM_STAT:xN1[PGM_ICNT] FAIL_PIN:Dn VECT_NAM:Cn TIME_SET:Cn OP_CODE:Cn TEST_TXT:Cn "
        "ALARM_ID:Cn PROG_TXT:Cn RSLT_TXT:Cn PATG_NUM:U1 SPIN_MAP:Dn",
    ),
    "BPS": (20, 10, "SEQ_NAME:Cn"),
    "EPS": (20, 20, ""),
    "GDR": (50, 10, "FLD_CNT:U2 GEN_DATA:Vn[FLD_CNT]"),
    "DTR": (50, 30, "TEXT_DAT:Cn"),
}

# The types the measurement flow keeps.
DEFAULT_TYPES = ("PTR", "MPR", "FTR", "HBR", "SBR", "MIR", "PRR")
TEST_TYPES = ("PTR", "MPR", "FTR")

_SPARK_TYPES: dict[str, T.DataType] = {
    "U1": T.ShortType(), "U2": T.IntegerType(), "U4": T.LongType(),
    "I1": T.ByteType(), "I2": T.ShortType(), "I4": T.IntegerType(),
    "R4": T.FloatType(), "R8": T.DoubleType(), "B1": T.ShortType(), "N1": T.ByteType(),
    "C1": T.StringType(), "Cn": T.StringType(), "Bn": T.BinaryType(),
    "Dn": T.StructType([T.StructField("n_bits", T.IntegerType()), T.StructField("bits", T.BinaryType())]),
    "Vn": T.StructType([T.StructField("tag", T.StringType()), T.StructField("value", T.StringType())]),
}


@dataclass(frozen=True)
class Field:
    """One field: its base type and, for arrays, the field holding the length."""

    name: str
    kind: str
    count_field: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        base = _SPARK_TYPES[self.kind]
        return T.ArrayType(base) if self.count_field else base


@dataclass(frozen=True)
class Layout:
    name: str
    typ: int
    sub: int
    fields: tuple[Field, ...]

    def schema(self, fields: list[str] | None = None) -> T.StructType:
        keep = None if fields is None else set(fields)
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields if keep is None or f.name in keep])


def _parse_field(name: str, kind: str) -> Field:
    if "[" in kind:
        base, count = kind.rstrip("]").split("[")
        return Field(name, base.removeprefix("x"), count)
    return Field(name, kind)


def _layout(name: str, typ: int, sub: int, fields: list[tuple[str, str]]) -> Layout:
    parsed = tuple(_parse_field(*f) for f in fields)
    seen: set[str] = set()
    for f in parsed:
        if f.kind not in _SPARK_TYPES:
            raise ValueError(f"{name}.{f.name}: unknown field type {f.kind!r}")
        if f.count_field and f.count_field not in seen:
            raise ValueError(f"{name}.{f.name}: length field {f.count_field!r} must come first")
        seen.add(f.name)
    return Layout(name, typ, sub, parsed)


_REGISTRY: dict[str, Layout] = {
    name: _layout(name, typ, sub, [tuple(f.split(":")) for f in text.split()])
    for name, (typ, sub, text) in _LAYOUTS.items()
}


def register_record_type(name: str, typ: int, sub: int, fields: list[tuple[str, str]]) -> Layout:
    """Add or redefine a record type: ``fields`` is [(name, type), ...] in read order."""
    layout = _layout(name.upper(), typ, sub, fields)
    _REGISTRY[layout.name] = layout
    return layout


def unregister_record_type(name: str) -> None:
    """Undo a registration; a built-in type returns to its original layout."""
    _REGISTRY.pop(name.upper(), None)
    if name.upper() in _LAYOUTS:
        typ, sub, text = _LAYOUTS[name.upper()]
        _REGISTRY[name.upper()] = _layout(name.upper(), typ, sub, [tuple(f.split(":")) for f in text.split()])


def layout_of(name: str) -> Layout:
    return _REGISTRY[name.upper()]


def record_types() -> list[str]:
    return list(_REGISTRY)


def record_names() -> dict[tuple[int, int], str]:
    return {(r.typ, r.sub): r.name for r in _REGISTRY.values()}


def field_names(record_type: str) -> list[str]:
    return [f.name for f in layout_of(record_type).fields]


def registry_frame(spark):
    """The registry as rows (record_type, field, field_type)."""
    rows = [(r.name, f.name, f.kind) for r in _REGISTRY.values() for f in r.fields]
    return spark.createDataFrame(rows, "record_type string, field string, field_type string")
