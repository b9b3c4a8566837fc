import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from changeloom.llm import transport as t


def packets(media):
    return [media[i : i + 188] for i in range(0, len(media), 188)]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 170, 183, 184, 4095, 4096, 4097, 40_000])
def test_round_trip(n):
    payload = t.payload_of("é" * (n // 2) + "x" * (n % 2))
    media = t.mux(payload)
    assert len(payload) >= 64 and len(payload) % 64 == 0 and len(media) % 188 == 0
    assert all(p[0] == 0x47 for p in packets(media))
    found = t.demux(media)
    assert found["payload"] == payload
    assert [found[c] for c in t._COUNTS[1:]] == [0] * 6
    assert found["programs"] == [{"number": 1, "pmt_pid": 0x1000, "streams": [{"pid": 0x100, "type": 6}]}]
    assert [u["pts"] for u in found["units"]] == [126_000 + 46_080 * k for k in range(len(found["units"]))]
    assert [k for k, u in enumerate(found["units"]) if u["random_access"]] == list(range(0, len(found["units"]), 8))


def test_crc_is_that_of_the_standard():
    assert t.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_damage_is_counted_and_the_rest_survives():
    payload = random.Random(0).randbytes(64 * 1024)
    media = packets(t.mux(payload))
    data = [k for k, p in enumerate(media) if (p[1] & 31) << 8 | p[2] == 0x100]
    lost = t.demux(b"".join(p for k, p in enumerate(media) if k != data[30]))
    assert lost["cc_errors"] == 1 and sum(u["damaged"] for u in lost["units"]) == 1 and len(lost["units"]) == 16
    repeated = t.demux(b"".join(media[: data[30] + 1] + media[data[30] :]))
    assert repeated["repeated"] == 1 and repeated["payload"] == payload
    shifted = t.demux(b"junk" + b"".join(media[:50]) + b"\x00\x47\x00" + b"".join(media[50:]))
    assert shifted["payload"] == payload and shifted["sync_losses"] == 2
    bad = bytearray(b"".join(media))
    bad[188 * data[5] + 1] |= 0x80
    assert t.demux(bytes(bad))["transport_errors"] == 1
    bad = bytearray(b"".join(media))
    bad[20] ^= 1
    assert t.demux(bytes(bad))["crc_errors"] == 1 and t.demux(bytes(bad))["payload"] == payload
    assert t.demux(b"")["payload"] == t.demux(b"G" * 100)["payload"] == t.demux(b"no packets" * 100)["payload"] == b""


def test_open_length_dts_and_discontinuity():
    head = b"\0\0\1\xe0\0\0\x80\xc0\x0a" + t._stamp(3, (1 << 33) - 1) + t._stamp(1, 77)
    body = head + b"v" * 300
    field = bytes((183 - len(body[184:]),))

    def stream(first_cc, second_cc, flag):
        return (
            t._table_packet(0, t._PAT, 0) + t._table_packet(0x1000, t._PMT, 0)
            + b"\x47\x41\x00" + bytes((0x10 | first_cc,)) + body[:184]
            + b"\x47\x01\x00" + bytes((0x30 | second_cc,)) + field + (bytes((flag,)) + b"\xff" * 183)[: field[0]] + body[184:]
        )

    found = t.demux(stream(3, 4, 0))
    assert found["units"][0] | {} == {"pid": 0x100, "pts": (1 << 33) - 1, "dts": 77, "random_access": False, "damaged": False, "length": 300, "offset": 0}
    assert found["payload"] == b"v" * 300 and found["cc_errors"] == 0
    assert t.demux(stream(3, 9, 0))["cc_errors"] == 1
    assert t.demux(stream(3, 9, 0x80))["cc_errors"] == 0


def test_a_lost_end_of_an_open_unit_is_marked():
    head = b"\0\0\1\xe0\0\0\x80\x80\x05" + t._stamp(2, 90_000)
    out, cc = [t._table_packet(0, t._PAT, 0), t._table_packet(0x1000, t._PMT, 0)], 0
    for _ in range(3):
        body = head + b"v" * (184 * 3 - len(head))
        for k in range(3):
            out.append(bytes((0x47, 0x41 if k == 0 else 0x01, 0x00, 0x10 | cc)) + body[184 * k : 184 * k + 184])
            cc = cc + 1 & 15
    whole, lost = t.demux(b"".join(out)), t.demux(b"".join(out[:4] + out[5:]))
    assert [u["damaged"] for u in whole["units"]] == [False] * 3 and whole["cc_errors"] == 0
    assert [u["damaged"] for u in lost["units"]] == [True, False, False] and lost["cc_errors"] == 1
    # a unit of stated length that is complete is not
    closed = packets(t.mux(b"q" * 64 * 200))
    units = [k for k, p in enumerate(closed) if (p[1] & 31) << 8 | p[2] == 0x100 and p[1] & 0x40]
    found = t.demux(b"".join(p for k, p in enumerate(closed) if not units[1] <= k < units[2]))
    assert not any(u["damaged"] for u in found["units"]) and found["cc_errors"] <= 1


def test_tables_over_several_packets():
    streams = b"".join(bytes((0x1B, 0xE0 | k >> 8, k & 255, 0xF0, 0)) for k in range(0x200, 0x200 + 60))
    pmt = t._section(2, 1, b"\xe2\x00\xf0\x00" + streams)
    first = b"\x47\x50\x00\x10\x00" + pmt[:183]
    second = (b"\x47\x10\x00\x11" + pmt[183:]).ljust(188, b"\xff")
    found = t.demux(t._table_packet(0, t._PAT, 0) + first + second)
    assert [s["pid"] for s in found["programs"][0]["streams"]] == list(range(0x200, 0x200 + 60))


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = t.query(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = docs[r.doc_id].encode()
        padded = raw + b"\0" * (-len(raw) % 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
        assert r.tail_crc32 == zlib.crc32(padded[-64:])
        assert r.media_sha256 == hashlib.sha256(t.mux(padded)).hexdigest() and r.media_bytes == len(t.mux(padded))


def test_nulls_long_texts_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "long " * 400_000), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"media": F.lit(1), "n_bytes": F.lit("clash"), "units": F.lit(0)})
    out = t.parse(t.encode(df), keep=("doc_id", "n_bytes")).collect()
    assert sorted(r.n_bytes for r in out) == [0, 0, 1, 1, 2_000_000]
    assert all(bytes(r.payload) in {t.payload_of(x) for _, x in rows} for r in out)
    assert t.parse(spark.createDataFrame([(1, None)], "k long, media binary"), keep=("k",)).first().payload is None
    assert t.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0
