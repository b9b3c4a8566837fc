"""Media columns: payloads stored as MPEG transport streams, and a parser for any such stream.

Stored form (`mux`): 188-byte packets. A program association table (PID 0), a program
map table and one elementary stream of private data, cut into access units of
`UNIT` bytes. Each unit is one packetised elementary stream (PES) packet with a
presentation time stamp; a sample is one byte at SAMPLE_RATE a second on the 90 kHz
clock. Every RAP_EVERY-th unit starts with random_access_indicator and a program clock
reference, and has both tables before it, so a reader can join there.

Parser (`demux`): finds packet sync (and finds it again after lost bytes), reads the
tables (sections of any number of packets, checked by their CRC), checks continuity
counters (repeated packets, gaps, discontinuity indicators, packets without payload),
reassembles PES packets with bounded or open length, and lists for each unit its PID,
PTS, DTS, place and length in the payload, and whether it is a random-access point.

Cases: null text counts as empty, and an empty payload has 64 zero bytes; null media
gives a null result; bytes without any packet give no programs, no units, an empty
payload; damaged packets are counted, what survives is returned; a unit that lost
packets is marked, also where its end may be among those lost. Texts of any length whose
stream Arrow holds (2 GB) are stored whole. Repeated rows give repeated results, an empty table an empty one,
and columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PACKET, SYNC = 188, 0x47
PAT_PID, PMT_PID, ES_PID, NULL_PID = 0x0000, 0x1000, 0x0100, 0x1FFF
PROGRAM, PRIVATE_PES, PRIVATE_STREAM_1 = 1, 0x06, 0xBD
UNIT, RAP_EVERY, SAMPLE_RATE, CLOCK, PTS_START, PTS_WRAP = 4096, 8, 8000, 90_000, 126_000, 1 << 33
#: PES stream ids without the optional header: map, padding, private 2, ECM, EMM, directory, DSM-CC, H.222.1 E.
PLAIN_STREAMS = frozenset((0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xFF, 0xF2, 0xF8))

_CRC_TABLE = []
for _i in range(256):
    _c = _i << 24
    for _ in range(8):
        _c = ((_c << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if _c & 0x80000000 else (_c << 1) & 0xFFFFFFFF
    _CRC_TABLE.append(_c)


def crc32_mpeg(data: bytes) -> int:
    """CRC-32/MPEG-2. Over a section with its own CRC it is 0."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc = ((crc << 8) & 0xFFFFFFFF) ^ _CRC_TABLE[(crc >> 24) ^ byte]
    return crc


def payload_of(text: str | None) -> bytes:
    """UTF-8 with zero bytes up to a positive multiple of 64."""
    raw = (text or "").encode()
    return raw + b"\0" * (-len(raw) % 64 if raw else 64)


def _section(table_id: int, extension: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | (len(body) + 9), extension, 0xC1, 0, 0)
    return head + body + struct.pack(">I", crc32_mpeg(head + body))


_PAT = _section(0x00, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID))
_PMT = _section(0x02, PROGRAM, struct.pack(">HH", 0xE000 | ES_PID, 0xF000) + struct.pack(">BHH", PRIVATE_PES, 0xE000 | ES_PID, 0xF000))


def _table_packet(pid: int, section: bytes, counter: int) -> bytes:
    head = struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10 | (counter & 15))
    return (head + b"\0" + section).ljust(PACKET, b"\xff")


def _stamp(prefix: int, value: int) -> bytes:
    return bytes((prefix << 4 | (value >> 29 & 0x0E) | 1, value >> 22 & 0xFF, (value >> 14 & 0xFE) | 1, value >> 7 & 0xFF, (value << 1 & 0xFE) | 1))


def _clock_reference(base: int) -> bytes:
    return struct.pack(">IH", base >> 1 & 0xFFFFFFFF, (base & 1) << 15 | 0x7E00)


def mux(payload: bytes) -> bytes:
    """The transport stream of one payload."""
    out, counter, tables = [], 0, 0
    for k, at in enumerate(range(0, max(len(payload), 1), UNIT)):
        data, rap = payload[at : at + UNIT], k % RAP_EVERY == 0
        pts = (PTS_START + at * CLOCK // SAMPLE_RATE) % PTS_WRAP
        pes = struct.pack(">IHBBB", 0x100 | PRIVATE_STREAM_1, len(data) + 8, 0x84, 0x80, 5) + _stamp(2, pts) + data
        if rap:
            out += (_table_packet(PAT_PID, _PAT, tables), _table_packet(PMT_PID, _PMT, tables))
            tables += 1
        first, control = True, b""
        sent = 0
        while sent < len(pes):
            control = b"\x50" + _clock_reference(pts) if rap and first else b""
            room = 184 - (1 + len(control) if control else 0)
            part = pes[sent : sent + room]
            if len(part) < room:  # the last packet is filled up in its adaptation field
                fill = 183 - len(part)
                control = ((control or b"\0") + b"\xff" * 183)[:fill] if fill else b""
                field = bytes((fill,)) + control
            else:
                field = bytes((len(control),)) + control if control else b""
            out.append(struct.pack(">BHB", SYNC, (0x4000 if first else 0) | ES_PID, (0x30 if field else 0x10) | counter) + field + part)
            counter, first, sent = (counter + 1) & 15, False, sent + len(part)
    return b"".join(out)


def _packets(data: bytes) -> tuple[np.ndarray, int]:
    """All whole packets as rows, and how often sync was lost."""
    buf = np.frombuffer(data, np.uint8)
    if len(buf) and len(buf) % PACKET == 0 and (buf[::PACKET] == SYNC).all():
        return buf.reshape(-1, PACKET), 0
    found, at, losses = [], 0, 0
    while at + PACKET <= len(buf):
        run = buf[at::PACKET][: (len(buf) - at) // PACKET] == SYNC
        good = int(run.argmin()) if not run.all() else len(run)
        if good and (good > 1 or at + PACKET == len(buf) or at + PACKET > len(buf) - PACKET):
            found.append(buf[at : at + good * PACKET].reshape(-1, PACKET))
            at += good * PACKET
            continue
        losses += 1
        spots = np.flatnonzero(buf[at + 1 :] == SYNC) + at + 1
        if not len(spots):
            break
        # sync is believed where the next packet agrees, or where the data end
        after = spots + PACKET
        sure = spots[(after >= len(buf)) | (buf[np.minimum(after, len(buf) - 1)] == SYNC)]
        sure = sure[sure + PACKET <= len(buf)]
        if not len(sure):
            break
        at = int(sure[0])
    return (np.concatenate(found) if found else np.empty((0, PACKET), np.uint8)), losses


def _read_stamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1


def _read_sections(parts: list[tuple[bool, bytes]]) -> tuple[list[bytes], int]:
    """Sections of one PID from its payloads (unit start, bytes); how many had a bad CRC."""
    found, bad, buf, open_ = [], 0, b"", False

    def drain() -> None:
        nonlocal buf, bad
        while len(buf) >= 3 and buf[0] != 0xFF:
            size = 3 + (struct.unpack(">H", buf[1:3])[0] & 0x0FFF)
            if len(buf) < size:
                return
            if crc32_mpeg(buf[:size]):
                bad += 1
            else:
                found.append(buf[:size])
            buf = buf[size:]
        if buf[:1] == b"\xff":
            buf = b""

    for start, data in parts:
        if start and data:
            pointer = data[0]
            if open_:
                buf += data[1 : 1 + pointer]
                drain()
            buf, open_ = data[1 + pointer :], True
        elif open_:
            buf += data
        drain()
    return found, bad


def demux(media: bytes) -> dict:
    """All that the parser finds in one stream; keys as in MEDIA_SCHEMA."""
    rows, losses = _packets(media)
    out = {"programs": [], "units": [], "sync_losses": losses, "packets": len(rows), "transport_errors": 0, "scrambled": 0, "cc_errors": 0, "repeated": 0, "crc_errors": 0}
    heads = rows[:, :6].astype(np.int64)
    pids = ((heads[:, 1] & 0x1F) << 8 | heads[:, 2]).tolist()
    flags = zip(pids, heads[:, 1].tolist(), heads[:, 3].tolist(), heads[:, 4].tolist(), heads[:, 5].tolist(), strict=True)
    parts: dict[int, list[tuple[bool, bool, bool, bytes]]] = {}
    last: dict[int, tuple[int, bytes]] = {}
    for k, (pid, second, fourth, size, control) in enumerate(flags):
        if pid == NULL_PID:
            continue
        if second & 0x80:
            out["transport_errors"] += 1
            continue
        adapted, filled, counter = fourth & 0x20, fourth & 0x10, fourth & 15
        jump = rap = False
        begin = 4
        if adapted:
            begin = 5 + size
            jump, rap = bool(size and control & 0x80), bool(size and control & 0x40)
        if not filled or begin > PACKET:
            continue
        data = rows[k, begin:].tobytes()
        gap = False
        if pid in last and not jump:
            was, same = last[pid]
            if counter == was and same == data:
                out["repeated"] += 1
                continue
            gap = counter != (was + 1) & 15
            out["cc_errors"] += gap
        last[pid] = counter, data
        if fourth & 0xC0:
            out["scrambled"] += 1
            continue
        parts.setdefault(pid, []).append((bool(second & 0x40), rap, gap, data))

    def sections(pid: int) -> list[bytes]:
        found, bad = _read_sections([(start, data) for start, _, _, data in parts.get(pid, [])])
        out["crc_errors"] += bad
        return found

    programs: dict[int, int] = {}
    for section in sections(PAT_PID):
        if section[0] == 0x00:
            for i in range(8, len(section) - 7, 4):
                number, pid = struct.unpack(">HH", section[i : i + 4])
                if number:  # 0 is the network table
                    programs[number] = pid & 0x1FFF
    streams: dict[int, int] = {}
    for number, pid in programs.items():
        own: dict[int, int] = {}
        for section in sections(pid):
            if section[0] != 0x02 or struct.unpack(">H", section[3:5])[0] != number:
                continue
            i = 12 + (struct.unpack(">H", section[10:12])[0] & 0x0FFF)
            while i + 5 <= len(section) - 4:
                kind, es, more = struct.unpack(">BHH", section[i : i + 5])
                own[es & 0x1FFF] = kind
                i += 5 + (more & 0x0FFF)
        out["programs"].append({"number": number, "pmt_pid": pid, "streams": [{"pid": p, "type": t} for p, t in own.items()]})
        streams |= own
    payload: list[bytes] = []
    place = 0
    for pid in streams:
        for unit, data in _units(pid, parts.get(pid, [])):
            out["units"].append(unit | {"offset": place})
            payload.append(data)
            place += len(data)
    return out | {"payload": b"".join(payload)}


def _units(pid: int, parts: list[tuple[bool, bool, bool, bytes]]) -> Iterator[tuple[dict, bytes]]:
    """PES packets of one PID: (unit, elementary bytes)."""
    held: list[bytes] = []
    rap = damaged = False
    for start, is_rap, gap, data in [*parts, (True, False, False, b"")]:
        if start:
            if held:
                yield from _pes(pid, b"".join(held), rap, damaged, gap)
            held, rap, damaged = [data], is_rap, False
        elif held:
            held.append(data)
            damaged |= gap


def _pes(pid: int, pes: bytes, rap: bool, damaged: bool, gap_behind: bool) -> Iterator[tuple[dict, bytes]]:
    """`gap_behind`: packets were lost between this unit's last one and the next unit's first.
    They may have been this unit's if its length is open."""
    if len(pes) < 6 or pes[:3] != b"\0\0\1":
        return
    size, begin, pts, dts = struct.unpack(">H", pes[4:6])[0], 6, None, None
    damaged |= len(pes) < 6 + size if size else gap_behind
    if size:
        pes = pes[: 6 + size]
    if pes[3] not in PLAIN_STREAMS and len(pes) >= 9 and pes[6] & 0xC0 == 0x80:
        begin = 9 + pes[8]
        if pes[7] & 0x80 and len(pes) >= 14:
            pts = dts = _read_stamp(pes[9:14])
        if pes[7] & 0xC0 == 0xC0 and len(pes) >= 19:
            dts = _read_stamp(pes[14:19])
    elif pes[3] == 0xBE:
        return
    yield {"pid": pid, "pts": pts, "dts": dts, "random_access": rap, "damaged": damaged, "length": len(pes) - begin}, pes[begin:]


def feature_of(parsed: dict) -> str:
    """A short text of what the timestamps and the samples say; the same for equal streams."""
    units, samples = parsed["units"], np.frombuffer(parsed["payload"], np.uint8)
    stamps = [u["pts"] for u in units if u["pts"] is not None]
    counts = np.bincount(samples, minlength=256)
    total = max(int(counts.sum()), 1)
    share = counts[counts > 0] / total
    mean = float((counts * np.arange(256)).sum() / total)
    turns = int(np.count_nonzero(np.diff((samples > 127).astype(np.int8)))) if len(samples) > 1 else 0
    return f"units={len(units)};pts={stamps[0] if stamps else ''}-{stamps[-1] if stamps else ''};rap={sum(u['random_access'] for u in units)};cc={parsed['cc_errors']};mean={mean:.3f};bits={-(share * np.log2(share)).sum() + 0.0:.3f};turns={turns}"


UNIT_TYPE = pa.struct([("pid", pa.int32()), ("pts", pa.int64()), ("dts", pa.int64()), ("random_access", pa.bool_()), ("damaged", pa.bool_()), ("offset", pa.int64()), ("length", pa.int64())])
PROGRAM_TYPE = pa.struct([("number", pa.int32()), ("pmt_pid", pa.int32()), ("streams", pa.list_(pa.struct([("pid", pa.int32()), ("type", pa.int32())])))])
_COUNTS = ("packets", "sync_losses", "transport_errors", "scrambled", "cc_errors", "repeated", "crc_errors")
MEDIA_FIELDS = (
    "programs array<struct<number:int,pmt_pid:int,streams:array<struct<pid:int,type:int>>>>, "
    "units array<struct<pid:int,pts:bigint,dts:bigint,random_access:boolean,damaged:boolean,offset:bigint,length:bigint>>, "
    + "".join(f"{c} bigint, " for c in _COUNTS)
    + "payload binary, feature string, media_bytes bigint, media_sha256 string"
)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (of the text), media (the transport stream of its padded bytes)."""
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in common.slices(batch, "text"):
                texts = part.column("text").to_pylist()
                sizes = pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64())
                media = pa.array([mux(payload_of(t)) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, media], [id_col, "n_bytes", "media"])

    return docs.mapInArrow(common.tidy(run), f"`{id_col}` {kind}, n_bytes bigint, media binary")


def parse(df: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep` columns as they are, and MEDIA_FIELDS of the stream in `media_col`."""
    df = df.select(*(F.col(c) for c in keep), F.col(media_col).alias("media"))
    fields = "".join(f"`{c}` {t}, " for c, t in df.drop("media").dtypes)

    def run(batches):
        for batch in batches:
            for part in common.slices(batch, "media"):
                rows = []
                for media in part.column("media").to_pylist():
                    if media is None:
                        rows.append({})
                        continue
                    found = demux(media)
                    rows.append(found | {"feature": feature_of(found), "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest()})
                col = lambda name, kind: pa.array([r.get(name) for r in rows], kind)
                new = [col("programs", pa.list_(PROGRAM_TYPE)), col("units", pa.list_(UNIT_TYPE)), *(col(c, pa.int64()) for c in _COUNTS)]
                new += [col("payload", pa.binary()), col("feature", pa.string()), col("media_bytes", pa.int64()), col("media_sha256", pa.string())]
                names = [*keep, "programs", "units", *_COUNTS, "payload", "feature", "media_bytes", "media_sha256"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], names)

    return df.mapInArrow(common.tidy(run), fields + MEDIA_FIELDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every whole text through a stored transport stream, read back from it."""
    docs = common.read_table(spark, sf_dir, "documents")
    out = parse(encode(docs), keep=("doc_id", "n_bytes"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substr("payload", F.greatest(F.octet_length("payload") - 63, F.lit(1)), F.lit(64))).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
        F.size("units").cast("long").alias("n_units"),
        F.transform(F.filter("units", lambda u: u["random_access"]), lambda u: F.struct(u["pts"], u["offset"])).alias("access_points"),
    )
