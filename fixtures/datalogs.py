"""Datalog files built from the given tables.

``datalog_files``: one file per part with every record type once; parts alternate byte
order and every third file is gzipped. ``lot_files``: few files with many tests and devices.
"""
from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dieflow.sources.stores import opened
from fixtures.encode import datalog

COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]

# Files that a task holds at a time.
SLICE = 500

# Order of records in each file after FAR.
SEQUENCE = [
    "ATR", "MIR", "RDR", "SDR", "PMR", "PGR", "PLR", "WCR", "WIR", "PIR", "BPS", "PTR", "MPR", "FTR", "EPS", "PRR", "WRR",
    "TSR", "HBR", "SBR", "PCR", "GDR", "DTR", "MRR",
]


def part_records(p) -> dict[str, dict]:
    """Field values of every record of a part's file."""
    key, size, price = int(p.p_partkey), int(p.p_size), float(p.p_retailprice)
    head = {"HEAD_NUM": 1, "SITE_NUM": size}
    pixel = f"{p.p_name};Pixel=R{size % 8}C{key % 4}"
    test = {**head, "TEST_NUM": key, "TEST_FLG": key % 4, "TEST_TXT": p.p_brand, "ALARM_ID": pixel}
    limits = {"OPT_FLAG": 0, "RES_SCAL": -3, "LLM_SCAL": 3, "HLM_SCAL": 3, "LO_LIMIT": -price, "HI_LIMIT": price, "UNITS": p.p_type}
    counts = {"PART_CNT": key, "RTST_CNT": 1, "ABRT_CNT": 2, "GOOD_CNT": size, "FUNC_CNT": 4}
    return {
        "ATR": {"MOD_TIM": 1000 + key, "CMD_LINE": p.p_name},
        "MIR": {"SETUP_T": key, "START_T": 1700000000 + key, "STAT_NUM": size, "MODE_COD": "P", "LOT_ID": p.p_brand, "PART_TYP": p.p_type,
                "NODE_NAM": "node", "JOB_NAM": p.p_name, "JOB_REV": "r1", "SBLOT_ID": "s1", "FLOOR_ID": f"floor{key % 3}", "SUPR_NAM": "last"},
        "RDR": {"NUM_BINS": 2, "RTST_BIN": [size, key % 1000]},
        "SDR": {"HEAD_NUM": 1, "SITE_GRP": 2, "SITE_CNT": 3, "SITE_NUM": [1, 2, size], "HAND_TYP": p.p_type},
        "PMR": {"PMR_INDX": size, "CHAN_TYP": 1, "CHAN_NAM": p.p_brand, **head},
        "PGR": {"GRP_INDX": size, "GRP_NAM": p.p_name, "INDX_CNT": 3, "PMR_INDX": [1, size, 3]},
        "PLR": {"GRP_CNT": 2, "GRP_INDX": [1, size], "GRP_MODE": [10, 20], "GRP_RADX": [2, 16], "PGM_CHAR": [p.p_brand, ""],
                "RTN_CHAR": ["", p.p_type], "PGM_CHAL": ["", ""], "RTN_CHAL": ["a", "b"]},
        "WCR": {"WAFR_SIZ": price, "DIE_HT": 0.5, "DIE_WID": 0.25, "WF_UNITS": 3, "WF_FLAT": "D", "CENTER_X": -size, "CENTER_Y": size, "POS_X": "R", "POS_Y": "U"},
        "WIR": {"HEAD_NUM": 1, "SITE_GRP": 255, "START_T": key, "WAFER_ID": p.p_brand},
        "PIR": head,
        "BPS": {"SEQ_NAME": p.p_name},
        "PTR": {**test, "PARM_FLG": 1, "RESULT": price, **limits, "C_RESFMT": "%9.3f", "LO_SPEC": 0.5, "HI_SPEC": 1.5},
        "MPR": {**test, "PARM_FLG": 2, "RTN_ICNT": 3, "RSLT_CNT": 2, "RTN_STAT": [1, size % 16, 15], "RTN_RSLT": [price, float(size)], **limits,
                "START_IN": 0.0, "INCR_IN": 0.25, "RTN_INDX": [7, 8, size], "UNITS_IN": "V"},
        "FTR": {**test, "OPT_FLAG": 3, "CYCL_CNT": key, "NUM_FAIL": size, "XFAIL_AD": -key, "VECT_OFF": -size, "RTN_ICNT": 1, "PGM_ICNT": 2,
                "RTN_INDX": [5], "RTN_STAT": [9], "PGM_INDX": [1, size], "PGM_STAT": [3, 4], "FAIL_PIN": (9, b"\x01\x80"), "VECT_NAM": p.p_type,
                "RSLT_TXT": "res", "PATG_NUM": 4, "SPIN_MAP": (8, bytes([size]))},
        "EPS": {},
        "PRR": {**head, "PART_FLG": 8 if key % 2 else 0, "NUM_TEST": 3, "HARD_BIN": key % 2, "SOFT_BIN": key % 3, "X_COORD": size - 25, "Y_COORD": -(key % 10),
                "TEST_T": key, "PART_ID": "" if key % 7 == 0 else f"P{key}", "PART_TXT": f"T{key}", "PART_FIX": b"\xab\xcd"},
        "WRR": {"HEAD_NUM": 1, "SITE_GRP": 255, "FINISH_T": key + 5, **counts, "WAFER_ID": p.p_brand, "USR_DESC": p.p_name},
        "TSR": {**head, "TEST_TYP": "P", "TEST_NUM": key, "EXEC_CNT": size, "FAIL_CNT": 1, "TEST_NAM": p.p_name, "OPT_FLAG": key % 64, "TEST_TIM": 0.5, "TST_SUMS": price},
        "HBR": {**head, "HBIN_NUM": key % 2, "HBIN_CNT": size, "HBIN_PF": "P" if key % 2 else "F", "HBIN_NAM": p.p_brand},
        "SBR": {**head, "SBIN_NUM": key % 3, "SBIN_CNT": size, "SBIN_PF": "F", "SBIN_NAM": p.p_type},
        "PCR": {**head, **counts},
        "GDR": {"FLD_CNT": 4, "GEN_DATA": [("U4", key), ("Cn", p.p_brand), ("I2", -size), ("N1", size % 16)]},
        "DTR": {"TEXT_DAT": p.p_name},
        "MRR": {"FINISH_T": key + 10, "DISP_COD": "Q", "USR_DESC": p.p_brand},
    }


def part_path(p) -> str:
    return f"p{p.p_partkey}.stdf" + (".gz" if p.p_partkey % 3 == 0 else "")


def part_file(p) -> bytes:
    values = part_records(p)
    data = datalog([(t, values[t]) for t in SEQUENCE], little=p.p_partkey % 2 == 0)
    return gzip.compress(data, 1, mtime=0) if p.p_partkey % 3 == 0 else data


def datalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): one file per part."""

    def build(batches):
        for pdf in batches:
            for at in range(0, len(pdf), SLICE):
                rows = list(pdf.iloc[at : at + SLICE].itertuples())
                yield pd.DataFrame({"path": [part_path(p) for p in rows], "content": [part_file(p) for p in rows]})

    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(*COLUMNS)
    return part.repartition(spark.sparkContext.defaultParallelism).mapInPandas(build, "path string, content binary")


def lot_file(parts, suppliers, little: bool) -> bytes:
    """A file shaped like a real lot: the parts are its tests, the suppliers its devices."""
    records = [("MIR", {"LOT_ID": "lot", "START_T": 1700000000})]
    for p in parts.sort_values("p_partkey").itertuples():
        values, kind = part_records(p), ("PTR", "MPR", "FTR")[p.p_partkey % 3]
        records.append((kind, values[kind]))
    for s in suppliers.sort_values("s_suppkey").itertuples():
        key = s.s_suppkey
        records.append(("PRR", {"PART_ID": "" if key % 7 == 0 else f"S{key % 500}", "PART_TXT": f"T{key}", "SOFT_BIN": key % 3, "X_COORD": 1, "Y_COORD": 2}))
    return datalog(records + [("MRR", {})], little)


def lot_files(spark: SparkSession, sf_dir: str, n_files: int) -> DataFrame:
    """(path, content): parts and suppliers spread over ``n_files`` files by key."""

    def build(key, parts, suppliers):
        return pd.DataFrame({"path": [f"lot{key[0]}.stdf"], "content": [lot_file(parts, suppliers, key[0] % 2 == 0)]})

    lot = lambda df, key: df.withColumn("lot", F.col(key) % n_files).repartition(n_files, "lot").groupBy("lot")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(*COLUMNS)
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey")
    return lot(part, "p_partkey").cogroup(lot(supplier, "s_suppkey")).applyInPandas(build, "path string, content binary")


def write_files(files: DataFrame, directory: str, prefixes: tuple[str, ...] = ("",)) -> None:
    """Store files in a folder, from the tasks that build them."""
    filesystem, folder = opened(directory)
    filesystem.create_dir(folder, recursive=True)

    def save(batches):
        filesystem, folder = opened(directory)
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for prefix in prefixes:
                    with filesystem.open_output_stream(f"{folder}/{prefix}{path}", compression=None) as out:
                        out.write(content)
            yield pdf[["path"]]

    files.mapInPandas(save, "path string").agg(F.count("*")).collect()


__all__ = ["SEQUENCE", "datalog_files", "lot_files", "part_file", "part_path", "part_records", "write_files"]
