"""Round trips: encoded rows come back from the walk and the decoder."""
import bz2
import gzip
import io
import random
import struct
import zipfile

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from dieflow.operators import records as r
from dieflow.sources import decode as d
from dieflow.sources import frames as fr, ranges, stores
from dieflow.sources.files import file_manifest, inline_small, stdf_files
from dieflow.sources.registry import layout_of, record_types, register_record_type, unregister_record_type
from fixtures.encode import body, datalog, record

MPR = {
    "TEST_NUM": 4294967295, "HEAD_NUM": 1, "SITE_NUM": 255, "TEST_FLG": 128, "RTN_ICNT": 3, "RSLT_CNT": 2, "RTN_STAT": [1, 15, 7],
    "RTN_RSLT": [1.5, -2.25], "TEST_TXT": "caf\xe9", "ALARM_ID": "a;Pixel=R1C2", "RES_SCAL": -3, "LO_LIMIT": -1.0, "RTN_INDX": [1, 2, 65535], "UNITS": "V",
}


def files(spark, *pairs):
    return spark.createDataFrame(list(pairs), "path string, content binary")


@pytest.mark.parametrize("little", [True, False])
def test_mpr_round_trip(spark, little):
    raw = fr.stdf_frames(files(spark, ("a", datalog([("MPR", MPR)], little))))
    row = d.decode_mpr(raw).collect()[0].asDict()
    assert row["record_index"] == 2
    for name, value in MPR.items():
        assert row[name] == value
    assert row["C_RESFMT"] == "" and row["HI_LIMIT"] == 0.0


def test_short_record_is_null_then_default(spark):
    for upto, last in (("OPT_FLAG", "ALARM_ID"), ("RESULT", "PARM_FLG"), ("TEST_NUM", None)):
        data = datalog([]) + record("PTR", {"TEST_NUM": 5, "PARM_FLG": 1, "ALARM_ID": "x"}, True, upto)
        df = d.decode_ptr(fr.stdf_frames(files(spark, ("a", data))))
        row = df.collect()[0].asDict()
        names = [f.name for f in layout_of("PTR").fields]
        cut = names.index(upto)
        assert all(row[n] is None for n in names[cut:])
        assert last is None or row[last] is not None
        full = d.with_defaults(df).collect()[0].asDict()
        assert full["LO_SPEC"] == 0.0 and full["UNITS"] == ""
    part = d.decode_other(fr.stdf_frames(files(spark, ("a", datalog([]) + record("WCR", {}, True, "WF_UNITS")))), "WCR")
    assert d.with_defaults(part).collect()[0].POS_X == " "


def test_field_pruning_reads_past_unwanted_fields(spark):
    raw = fr.stdf_frames(files(spark, ("a", datalog([("MPR", MPR)]))))
    df = d.decode_mpr(raw, ["UNITS", "RTN_RSLT"])
    assert df.columns == ["path", "record_index", "RTN_RSLT", "UNITS"]
    assert df.collect()[0].UNITS == "V"


def test_compressed_files(spark):
    data = datalog([("MIR", {"LOT_ID": "L"}), ("MRR", {})])
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("inner.stdf", data)
    df = fr.stdf_frames(files(spark, ("a.stdf", data), ("b.stdf.gz", gzip.compress(data)), ("c.stdf.bz2", bz2.compress(data)), ("d.stdf.zip", packed.getvalue())))
    assert df.groupBy("path").count().filter("count = 3").count() == 4


def test_broken_files_give_error_rows(spark):
    good = datalog([("PIR", {}), ("MRR", {})])
    df = fr.stdf_frames(files(spark, ("cut", good[:-2]), ("text", b"hello world"), ("empty", b""), ("x.gz", b"no gzip"), ("head", good + b"\x01\x00")))
    errors = {row.path: row.error for row in df.filter("error is not null").collect()}
    assert errors["cut"] == fr.TRUNCATED and errors["head"] == fr.TRUNCATED
    assert errors["text"] == errors["empty"] == fr.NOT_FAR and errors["x.gz"].startswith("unreadable")
    assert df.filter("path = 'cut' and error is null").count() == 2
    assert d.read_records(df.sparkSession.createDataFrame([("cut", bytearray(good[:-2]))], "path string, content binary"), {"PIR": ["HEAD_NUM"]}).count() == 2


def test_records_across_chunks(spark, monkeypatch):
    """The walk carries a record over the end of a chunk."""
    data = datalog([("DTR", {"TEXT_DAT": "x" * (i % 250)}) for i in range(500)])
    monkeypatch.setattr(fr, "_CHUNK", 64)
    batches = list(fr.walk("a", io.BytesIO(data), None))
    assert sum(b.num_rows for b in batches) == 501
    assert [i for b in batches for i in b.column("record_index").to_pylist()] == list(range(1, 502))
    bodies = [x for b in batches for x in b.column("body").to_pylist()]
    assert bodies[1:] == [body("DTR", {"TEXT_DAT": "x" * (i % 250)}, True) for i in range(500)]


def test_large_files_are_streamed_by_path(spark, tmp_path):
    data = datalog([("PTR", {"TEST_NUM": i, "RESULT": i / 2}) for i in range(50)])
    (tmp_path / "a.stdf").write_bytes(data)
    (tmp_path / "b.STDF").write_bytes(data)
    (tmp_path / "c.txt").write_bytes(data)
    whole, streamed = stdf_files(spark, str(tmp_path)), stdf_files(spark, str(tmp_path), inline_bytes=10)
    assert streamed.filter("content is null").count() == 2
    key = ["path", "record_index", "rec_typ", "body"]
    a, b = fr.stdf_frames(whole).select(*key), fr.stdf_frames(streamed).select(*key)
    assert a.count() == 102 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert file_manifest(whole).exceptAll(file_manifest(streamed)).count() == 0
    assert inline_small(whole, 0).filter("content is null").count() == 2


def starts_of(data, little=True):
    out, pos = [], 0
    while pos + 4 <= len(data):
        out.append(pos)
        pos += 4 + int.from_bytes(data[pos:pos + 2], "little" if little else "big")
    return out


@pytest.mark.parametrize("split", [100, 1000, 50_000])
@pytest.mark.parametrize("little", [True, False])
def test_ranges_of_a_large_file_equal_the_whole(spark, tmp_path, split, little):
    rng = random.Random(split)
    records = [("PIR", {})] + [("PTR", {"TEST_NUM": i, "RESULT": i / 4, "TEST_TXT": "t" * rng.randrange(200)}) for i in range(1500)]
    tricky = [("GDR", {"FLD_CNT": 1, "GEN_DATA": [("Cn", "\x00\x01\x0f\x0a" * 50)]}) if i % 3 else r for i, r in enumerate(records)]
    data = datalog(records, little)
    (tmp_path / "tricky.stdf").write_bytes(datalog(tricky, little))
    (tmp_path / "good.stdf").write_bytes(data)
    (tmp_path / "cut.stdf").write_bytes(data[:-5])
    (tmp_path / "odd.stdf").write_bytes(data + b"\x03\x00\xc8\xc9abc" + data[6:2000])
    (tmp_path / "small.stdf").write_bytes(datalog([("MRR", {})]))
    (tmp_path / "text.stdf").write_bytes(b"no datalog " * 1000)
    (tmp_path / "packed.stdf.gz").write_bytes(gzip.compress(data))
    found = stdf_files(spark, str(tmp_path), inline_bytes=50)
    columns = ["path", "record_index", "rec_typ", "rec_sub", "body", "error"]
    whole, ranged = fr.stdf_frames(found).select(*columns), fr.stdf_frames(found, split_bytes=split).select(*columns)
    # One unit for every range in which a record starts.
    assert fr.walk_units(found, split).filter("path like '%good%'").count() == len({p // split for p in starts_of(data, little)})
    a, b = [sorted(df.collect(), key=lambda r: (r.path, r.record_index)) for df in (whole, ranged)]
    assert a == b and len(a) > 4500


def with_vendor_records(n, rng, little=True):
    """A record of a type nobody registered after every ten, with bodies that look like records."""
    mark = "<" if little else ">"
    out = [datalog([], little)]
    for i in range(n):
        out.append(record("PTR", {"TEST_NUM": i, "RESULT": i / 4, "TEST_TXT": "t" * rng.randrange(60)}, little))
        if i % 10 == 9:
            inner = rng.randbytes(rng.randrange(300)) if i % 20 == 9 else record("PIR", {}, little) * 40
            out.append(struct.pack(mark + "HBB", len(inner), 200, 201) + inner)
    return b"".join(out)


def test_a_file_with_vendor_records_is_walked_in_ranges(spark, tmp_path):
    data = with_vendor_records(120_000, random.Random(1))
    # Long enough that later ranges look only at what lies shortly before them.
    assert len(data) > 2 * ranges.LEADS[0]
    (tmp_path / "a.stdf").write_bytes(data)
    found = stdf_files(spark, str(tmp_path), inline_bytes=50)
    units = fr.walk_units(found, 1 << 20).collect()
    starts = starts_of(data)
    assert len(units) == (len(data) - 1 >> 20) + 1
    for u in units:
        assert starts[u.base] == u.first
    columns = ["record_index", "rec_typ", "rec_sub", "body", "error"]
    whole, ranged = fr.stdf_frames(found).select(*columns), fr.stdf_frames(found, split_bytes=1 << 20).select(*columns)
    same = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.max("record_index")).first()
    assert same(whole) == same(ranged) and same(whole)[0] == len(starts)


@pytest.mark.parametrize("little", [True, False])
def test_every_range_knows_its_true_entry(tmp_path, little, monkeypatch):
    """Whatever a range starts in, the true walk is among those left, and maps lead from the file's start to its end."""
    monkeypatch.setattr(ranges, "LONGEST", 700)
    monkeypatch.setattr(ranges, "STRETCH", 1024)
    monkeypatch.setattr(ranges, "CHUNK", 2048)
    data = with_vendor_records(4000, random.Random(2), little)
    runs = datalog([("DTR", {"TEXT_DAT": chr(1) * 255})] * 900 + [("DTR", {"TEXT_DAT": chr(0) * 250})] * 900, little)
    for name, content in (("a", data), ("cut", data[:-3]), ("runs", runs), ("text", b"no datalog " * 900)):
        (tmp_path / name).write_bytes(content)
        starts = starts_of(content, little)
        for split, lead in ((700, 30_000), (5000, 20_000), (60_000, 70_000)):
            cuts = range(0, len(content), split)
            batch = pa.RecordBatch.from_pylist([
                {"path": str(tmp_path / name), "range": i, "begin": at, "end": min(at + split, len(content)), "length": len(content)} for i, at in enumerate(cuts)
            ])
            maps = pa.Table.from_batches(ranges._scout(iter([batch]), stores.StoreFile, (lead,))).to_pandas()
            units = ranges._compose(maps).to_dict("records")
            assert units[0]["first"] == 0 and units[0]["base"] == 0 and pd.isna(units[-1]["stop"])
            assert all(u["stop"] == v["first"] for u, v in zip(units, units[1:]))
            if name == "text":
                assert len(units) == 1
            else:
                assert all(starts[u["base"]] == u["first"] for u in units)
                if name == "a":
                    assert len(units) == len({p // split for p in starts})


@pytest.mark.parametrize("little", [True, False])
@pytest.mark.parametrize("suffix, pack", [("gz", gzip.compress), ("bz2", bz2.compress)])
def test_members_of_a_packed_file_are_units(spark, tmp_path, suffix, pack, little):
    rng = random.Random(6)
    data = with_vendor_records(6000, rng, little)
    cuts = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(40))})
    # A cut inside a header, and a member without a record's start.
    header = starts_of(data, little)[3000]
    cuts = sorted({*cuts, header + 1, header + 2, header + 9, header + 12})
    pieces = [pack(data[a:b]) for a, b in zip(cuts, cuts[1:])]
    (tmp_path / f"many.stdf.{suffix}").write_bytes(b"".join(pieces))
    (tmp_path / f"one.stdf.{suffix}").write_bytes(pack(data))
    (tmp_path / f"cut.stdf.{suffix}").write_bytes(b"".join(pieces)[:-5])
    (tmp_path / f"short.stdf.{suffix}").write_bytes(b"".join([*pieces[:-1], pack(data[cuts[-2]:-3])]))
    (tmp_path / f"text.stdf.{suffix}").write_bytes(pack(b"no datalog") * 300)
    found = stdf_files(spark, str(tmp_path), inline_bytes=10)
    columns = ["path", "record_index", "rec_typ", "rec_sub", "body", "error"]
    units = fr.walk_units(found, split_packed=3000).groupBy("path").count().collect()
    counts = {u.path.rsplit("/", 1)[1].split(".")[0]: u["count"] for u in units}
    assert counts["many"] > 8 and counts["short"] > 8 and counts["one"] == counts["text"] == 1
    whole, parts = fr.stdf_frames(found).select(*columns), fr.stdf_frames(found, split_packed=3000).select(*columns)
    a, b = [sorted(df.collect(), key=lambda r: (r.path, r.record_index)) for df in (whole, parts)]
    assert a == b and len(a) == 3 * len(starts_of(data, little)) + 2


def test_walks_that_never_meet_leave_one_part(tmp_path):
    """Bodies of one repeated byte keep all walks apart; the rest of the file is then one part."""
    data = datalog([("DTR", {"TEXT_DAT": chr(255) * 255})] * 3000)
    (tmp_path / "a").write_bytes(data)
    rows = [{"path": str(tmp_path / "a"), "range": i, "begin": i * 100_000, "end": min((i + 1) * 100_000, len(data)), "length": len(data)} for i in range(len(data) // 100_000 + 1)]
    maps = pa.Table.from_batches(ranges._scout(iter([pa.RecordBatch.from_pylist(rows)]), stores.StoreFile, (300,))).to_pandas()
    units = ranges._compose(maps).to_dict("records")
    starts = starts_of(data)
    assert all(starts[u["base"]] == u["first"] for u in units) and pd.isna(units[-1]["stop"])


_TEXT = st.text(st.characters(min_codepoint=32, max_codepoint=255), max_size=20)
_VALUE = {
    "U1": st.integers(0, 255), "U2": st.integers(0, 65535), "U4": st.integers(0, 2**32 - 1), "I1": st.integers(-128, 127), "I2": st.integers(-(2**15), 2**15 - 1),
    "I4": st.integers(-(2**31), 2**31 - 1), "R4": st.floats(width=32, allow_nan=False), "B1": st.integers(0, 255), "N1": st.integers(0, 15),
    "C1": st.sampled_from("APF "), "Cn": _TEXT, "Bn": st.binary(max_size=20),
}


@st.composite
def values_of(draw, name):
    layout = layout_of(name)
    counts = {f.count_field for f in layout.fields if f.count_field}
    sizes = {c: draw(st.integers(0, 5)) for c in counts}
    out = {}
    for f in layout.fields:
        if f.name in sizes:
            out[f.name] = sizes[f.name]
        elif f.kind == "Dn":
            n = draw(st.integers(0, 20))
            out[f.name] = (n, draw(st.binary(min_size=(n + 7) // 8, max_size=(n + 7) // 8)))
        elif f.kind == "Vn":
            out[f.name] = [("U2", draw(_VALUE["U2"])) for _ in range(sizes[f.count_field])]
        elif f.count_field:
            out[f.name] = [draw(_VALUE[f.kind]) for _ in range(sizes[f.count_field])]
        else:
            out[f.name] = draw(_VALUE[f.kind])
    return out


@pytest.mark.parametrize("name", record_types())
def test_every_type_round_trips(name):
    import numpy as np
    import pyarrow as pa

    layout = layout_of(name)

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(values_of(name), st.booleans()), min_size=1, max_size=4))
    def check(rows):
        bodies = pa.array([body(name, v, little) for v, little in rows], pa.binary())
        out = d.decode_bodies(layout, bodies, np.array([little for _, little in rows]), {f.name for f in layout.fields})
        for i, (want, _) in enumerate(rows):
            for f in layout.fields:
                got = out[f.name][i].as_py()
                expected = want[f.name]
                if f.kind == "Vn":
                    expected = [{"tag": t, "value": str(v)} for t, v in expected]
                elif f.kind == "Dn":
                    expected = {"n_bits": expected[0], "bits": expected[1]}
                if f.count_field:
                    expected = expected or None
                assert got == expected, f.name

    check()


ALL_TAGS = [
    ("U1", 200), ("B0", None), ("U2", 60_000), ("U4", 4_000_000_000), ("I1", -7), ("I2", -30_000), ("I4", -2_000_000_000), ("R4", 1.25), ("R8", -2.5e300),
    ("Cn", "caf\xe9"), ("Bn", b"\x00\xff"), ("Dn", (9, b"\x01\x80")), ("N1", 11), ("Cn", ""), ("Bn", b""),
]
AS_TEXT = [
    "200", None, "60000", "4000000000", "-7", "-30000", "-2000000000", "1.25", "-2.5e+300", "caf\xe9", "00FF", "0180", "11", "", "",
]


@pytest.mark.parametrize("little", [True, False])
def test_every_tag_of_generic_data(spark, little):
    """Rows with all tags, in different orders and numbers; one cut off inside each value; one with an unknown tag."""
    n = len(ALL_TAGS)
    turned = [[(i + k) % n for i in range(n - k)] for k in range(n)]
    whole = [("GDR", {"FLD_CNT": len(o), "GEN_DATA": [ALL_TAGS[i] for i in o]}) for o in turned] + [("GDR", {"FLD_CNT": 0})]
    data = datalog(whole, little)
    for tail, count in ((b"\x02\x01", 1), (b"\x0a\x05ab", 2), (b"\x63\x01\x07", 2), (b"\x0c\x09", 1)):
        head = count.to_bytes(2, "little" if little else "big") + tail
        data += struct.pack(("<" if little else ">") + "HBB", len(head), 50, 10) + head
    rows = [r.GEN_DATA for r in d.decode_other(fr.stdf_frames(files(spark, ("a", data))), "GDR").orderBy("record_index").collect()]
    for order, got in zip(turned, rows):
        assert [(x.tag, x.value) for x in got] == [(ALL_TAGS[i][0], AS_TEXT[i]) for i in order]
    assert rows[n] is None
    assert [[(x.tag, x.value) for x in got] for got in rows[n + 1:]] == [[("U2", None)], [("Cn", "ab")], [("?99", None), ("U1", "7")], [("Dn", "")]]


def test_generic_data_decodes_at_the_rate_of_plain_fields():
    import time

    import numpy as np

    def rate(name, values):
        bodies, little, layout = pa.array([body(name, v, True) for v in values], pa.binary()), np.ones(len(values), bool), layout_of(name)
        began = time.process_time()
        for _ in range(3):
            d.decode_bodies(layout, bodies, little, {f.name for f in layout.fields})
        return time.process_time() - began

    ptr = rate("PTR", [{"TEST_NUM": i, "RESULT": 0.5, "TEST_TXT": "text", "ALARM_ID": "a;Pixel=R1C2", "UNITS": "V"} for i in range(20_000)])
    gdr = rate("GDR", [{"FLD_CNT": 4, "GEN_DATA": [("U4", i), ("Cn", "text"), ("I2", -i % 100), ("N1", i % 16)]} for i in range(20_000)])
    assert gdr < 2.5 * ptr


def test_registered_type(spark):
    register_record_type("ABC", 200, 7, [("N", "U1"), ("V", "xR4[N]"), ("T", "Cn")])
    try:
        data = datalog([("ABC", {"N": 2, "V": [0.5, 1.5], "T": "t"})])
        raw = fr.stdf_frames(files(spark, ("a", data)))
        row = d.decode(raw, "ABC").collect()[0]
        assert (row.V, row.T) == ([0.5, 1.5], "t")
        assert r.record_fields(d.decode(raw, "ABC"), "ABC").collect()[0].fields == {"N": "2", "V": "0.5,1.5", "T": "t"}
    finally:
        unregister_record_type("ABC")
    with pytest.raises(KeyError):
        layout_of("ABC")
    with pytest.raises(ValueError):
        register_record_type("BAD", 1, 1, [("A", "xU1[N]")])


def test_unknown_records_stay_raw(spark):
    data = datalog([("PIR", {})]) + b"\x03\x00\xc8\xc9abc"
    rows = fr.record_type_column(fr.stdf_frames(files(spark, ("a", data)))).collect()
    assert [x.record_type for x in rows] == ["FAR", "PIR", "???"] and bytes(rows[2].body) == b"abc"


def test_files_are_built_in_slices(spark, tmp_path):
    from fixtures import datalogs

    rows = [(i, f"name {i}", "Brand#1", "SMALL", i % 50, 900.0 + i) for i in range(2 * datalogs.SLICE + 7)]
    df = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    df.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    built = {r.path: bytes(r.content) for r in datalogs.datalog_files(spark, str(tmp_path)).collect()}
    parts = [r for r in df.collect()]
    assert built == {datalogs.part_path(p): datalogs.part_file(p) for p in parts}
