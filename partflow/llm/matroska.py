"""Media columns in Matroska: a writer of audio tracks and a parser of EBML into packet tables.

The parser reads variable-length element ids and sizes (unknown sizes of segments and clusters
included), clusters, simple blocks and block groups with all three lacings, and cues. A packet is a
frame: its track, its time, and the bytes of the file that hold it. What is cut off or damaged gives
no packets, and what comes before it does.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import table, text_hash, written

# Fixed values of the format: element ids.
EBML, DOC_TYPE, SEGMENT, INFO, SCALE, MUXER, WRITER = 0x1A45DFA3, 0x4282, 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741
TRACKS, TRACK, NUMBER, UID, KIND, LACED, CODEC = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86
AUDIO, RATE, CHANNELS, DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIME, SIMPLE, GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE, CUE_TIME, CUE_PLACE, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

SAMPLES_A_SECOND, FRAME_BYTES, FRAMES_A_BLOCK, BLOCKS_A_CLUSTER, PAD = 8000, 1024, 8, 16, 64


@dataclass
class Packet:
    track: int
    timestamp_ns: int
    offset: int
    size: int
    keyframe: bool


@dataclass
class Media:
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time in ns, track, offset of the cluster


def _size(n: int) -> bytes:
    """The shortest coding of a size; a size of all ones is reserved."""
    width = next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(kind: int, data: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + _size(len(data)) + data


def _number(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def laced(frames: list[bytes], lacing: int) -> bytes:
    """The head of sizes and the frames of a block."""
    if lacing == NO_LACING:
        return frames[0]
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if lacing == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == EBML_LACING:
        head += _size(sizes[0])
        for before, n in zip(sizes, sizes[1:-1]):
            width = next(w for w in range(1, 9) if abs(n - before) < 1 << 7 * w - 1)
            bias = (1 << 7 * width - 1) - 1
            head += (n - before + bias | 1 << 7 * width).to_bytes(width, "big")
    return head + b"".join(frames)


def write_audio(samples: bytes, rate: int = SAMPLES_A_SECOND) -> bytes:
    """A file with one track of unsigned 8-bit samples, in laced blocks, clusters and cues."""
    frames = [samples[i : i + FRAME_BYTES] for i in range(0, len(samples), FRAME_BYTES)]
    ms = lambda frame: frame * FRAME_BYTES * 1000 // rate
    info = element(INFO, _number(SCALE, 1_000_000) + element(MUXER, b"partflow") + element(WRITER, b"partflow"))
    audio = element(RATE, struct.pack(">d", rate)) + _number(CHANNELS, 1) + _number(DEPTH, 8)
    track = _number(NUMBER, 1) + _number(UID, 1) + _number(KIND, 2) + _number(LACED, 1)
    track += element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, audio)
    body, cues = [info + element(TRACKS, element(TRACK, track))], b""
    place, step = len(body[0]), FRAMES_A_BLOCK * BLOCKS_A_CLUSTER
    for first in range(0, len(frames), step):
        start, data = ms(first), _number(TIME, ms(first))
        for at in range(first, min(first + step, len(frames)), FRAMES_A_BLOCK):
            part = frames[at : min(at + FRAMES_A_BLOCK, first + step)]
            even = len({len(f) for f in part}) == 1
            lacing = NO_LACING if len(part) == 1 else FIXED if even else EBML_LACING
            data += element(SIMPLE, b"\x81" + struct.pack(">hB", ms(at) - start, 0x80 | lacing << 1) + laced(part, lacing))
        cues += element(CUE, _number(CUE_TIME, start) + element(CUE_PLACE, _number(CUE_TRACK, 1) + _number(CUE_CLUSTER, place)))
        body.append(element(CLUSTER, data))
        place += len(body[-1])
    body.append(element(CUES, cues))
    return element(EBML, element(DOC_TYPE, b"matroska")) + element(SEGMENT, b"".join(body))


def _vint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int | None, int]:
    """A variable-length number and where it ends; None for an unknown size."""
    width = 9 - data[at].bit_length()
    if width > 8 or at + width > len(data):
        raise ValueError(f"no variable-length number at {at}")
    n = int.from_bytes(data[at : at + width], "big")
    if keep_marker:
        return n, at + width
    n &= (1 << 7 * width) - 1
    return (None if n == (1 << 7 * width) - 1 else n), at + width


def elements(data: bytes, at: int, end: int, ends_at: frozenset[int] = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(id, start, end of the content) of the elements in data[at:end].

    An element of unknown size lasts until one that can't be in it (a cluster until a cluster or
    cues), which ``ends_at`` names for the level above. Of those that go on beyond the end only segments and
    clusters come, up to there. Bytes that begin no element end the level.
    """
    while at < end:
        try:
            kind, start = _vint(data, at, keep_marker=True)
            if kind in ends_at:
                return
            n, start = _vint(data, start)
        except (ValueError, IndexError):
            return
        if start > end:
            return
        stop = end if n is None else start + n
        if n is None and kind == CLUSTER:
            stop = start
            for _, _, stop in elements(data, start, end, frozenset({CLUSTER, CUES, TRACKS, INFO})):
                pass
        if stop <= end:
            yield kind, start, stop
        elif kind in (SEGMENT, CLUSTER):
            yield kind, start, end
        at = stop


def _lacing_sizes(data: bytes, at: int, end: int, lacing: int) -> tuple[list[int], int]:
    """The sizes of a block's frames and where the first begins; a ValueError if they don't fill data[at:end]."""
    if lacing == NO_LACING:
        return [end - at], at
    if at >= end:
        raise ValueError("a laced block without a head")
    count, at, sizes = data[at] + 1, at + 1, []
    if lacing == FIXED:
        if (end - at) % count:
            raise ValueError("frames of a fixed size don't fill the block")
        return [(end - at) // count] * count, at
    for i in range(count - 1):
        if lacing == XIPH:
            n = 0
            while at < end and data[at] == 255:
                n, at = n + 255, at + 1
            if at >= end:
                raise ValueError("a size beyond the block")
            n, at = n + data[at], at + 1
        else:
            began = at
            if at >= end:
                raise ValueError("a size beyond the block")
            n, at = _vint(data, at)
            if n is None:
                n = (1 << 7 * (at - began)) - 1
            if i:
                n += sizes[-1] - ((1 << 7 * (at - began) - 1) - 1)
        sizes.append(n)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("frames beyond the block")
    return sizes, at


def parse(data: bytes) -> Media:
    """Tracks, packets in file order, and cues, each position of a cue point on its own.

    A block cut off at the file's end, or whose sizes don't fill it, gives no packets; an element cut
    off or without what it must hold is passed over. Any bytes give a result, none at all an empty one.
    """
    media, scale = Media(), 1_000_000
    number = lambda a, b: int.from_bytes(data[a:b], "big")
    above_cluster = frozenset({CLUSTER, CUES, TRACKS, INFO})

    def block(a: int, b: int, cluster_time: int, simple: bool) -> None:
        try:
            track, at = _vint(data, a)
            if track is None or at + 3 > b:
                return
            relative, flags = struct.unpack_from(">hB", data, at)
            sizes, at = _lacing_sizes(data, at + 3, b, flags >> 1 & 3)
        except (ValueError, IndexError):
            return
        frame_ns = 0
        if (rate := media.tracks.get(track, {}).get("rate")) and media.tracks[track].get("depth"):
            frame_ns = 8e9 / (rate * media.tracks[track]["depth"] * (media.tracks[track].get("channels") or 1))
        before = 0
        for n in sizes:  # frames after the first follow by their length, where samples have a fixed size
            time = (cluster_time + relative) * scale + round(before * frame_ns)
            media.packets.append(Packet(track, time, at, n, simple and bool(flags & 0x80)))
            at, before = at + n, before + n

    for top, a, b in elements(data, 0, len(data)):
        if top != SEGMENT:
            continue
        segment = a
        for kind, a, b in elements(data, a, b):
            if kind == INFO:
                scale = next((number(c, d) for k, c, d in elements(data, a, b) if k == SCALE), scale)
            elif kind == TRACKS:
                for k1, a, b in elements(data, a, b):
                    track: dict = {}
                    for k, c, d in elements(data, a, b) if k1 == TRACK else ():
                        if k in (NUMBER, KIND):
                            track["number" if k == NUMBER else "kind"] = number(c, d)
                        elif k == CODEC:
                            track["codec"] = data[c:d].decode("utf-8", "replace")
                        elif k == AUDIO:
                            for k2, e, f in elements(data, c, d):
                                if k2 == RATE and f - e in (4, 8):
                                    rate = struct.unpack(">d" if f - e == 8 else ">f", data[e:f])[0]
                                    track["rate"] = rate if 0 < rate < 1e12 else None
                                elif k2 in (CHANNELS, DEPTH):
                                    track["channels" if k2 == CHANNELS else "depth"] = number(e, f)
                    if "number" in track:
                        media.tracks[track["number"]] = track
            elif kind == CLUSTER:
                time = 0
                for k, c, d in elements(data, a, b, above_cluster):
                    if k == TIME:
                        time = number(c, d)
                    elif k == SIMPLE:
                        block(c, d, time, True)
                    elif k == GROUP:
                        for k2, e, f in elements(data, c, d):
                            if k2 == BLOCK:
                                block(e, f, time, False)
            elif kind == CUES:
                for k1, a, b in elements(data, a, b):
                    parts = list(elements(data, a, b)) if k1 == CUE else []
                    time = next((number(c, d) for k, c, d in parts if k == CUE_TIME), None)
                    for k, c, d in parts:
                        place = {k2: number(e, f) for k2, e, f in elements(data, c, d)} if k == CUE_PLACE else {}
                        if time is not None and CUE_TRACK in place and CUE_CLUSTER in place:
                            media.cues.append((time * scale, place[CUE_TRACK], segment + place[CUE_CLUSTER]))
    return media


def padded(text: str | None) -> bytes:
    payload = (text or "").encode()
    return payload + bytes(-len(payload) % PAD if payload else PAD)


def feature(samples: bytes, media: Media) -> str:
    """Packets, cues, milliseconds, and mean, deviation and sign changes of the samples about their middle (0 if none)."""
    if not samples:
        return f"packets={len(media.packets)} cues={len(media.cues)} ms=0 mean=0.0000 dev=0.0000 changes=0"
    x = np.frombuffer(samples, dtype=np.uint8).astype(np.int64) - 128
    changes = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    ms = len(x) * 1000 // SAMPLES_A_SECOND
    return f"packets={len(media.packets)} cues={len(media.cues)} ms={ms} mean={x.mean():.4f} dev={x.std():.4f} changes={changes}"


def to_media(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, n_bytes, media): each text, padded with zeros to 64 bytes, as an audio file.

    A null text is an empty one, and an empty one 64 zeros. Each row gets a row, repeated ones too.
    Texts of any length are taken whole, one at a time. Other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """

    def encode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column("text").to_pylist()
                n = pa.array([len((t or "").encode()) for t in texts], pa.int64())
                media = pa.array([write_audio(padded(t)) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), n, media], ["doc_id", "text_key", "n_bytes", "media"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", text_hash(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(encode, f"doc_id {kind}, text_key long, n_bytes long, media binary")


def packet_table(media: DataFrame) -> DataFrame:
    """The columns of media but the file itself, with a row for each packet: track, timestamp_ns, offset, size, keyframe.

    Null, empty and damaged files give the packets that they hold whole, if any. Input columns with one
    of these names are replaced; rows that repeat give their packets each; an empty table gives an empty result.
    """
    kept = [c for c in media.columns if c not in ("media", "track", "timestamp_ns", "offset", "size", "keyframe")]

    def explode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [parse(m.as_py() or b"").packets for m in part.column("media")]
                rows = pa.array(np.repeat(np.arange(part.num_rows), [len(x) for x in found]))
                flat = [p for x in found for p in x]
                columns = [part.column(c).take(rows) for c in kept]
                columns += [pa.array([getattr(p, k) for p in flat], t) for k, t in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays(columns, kept + names)

    names, kinds = ["track", "timestamp_ns", "offset", "size", "keyframe"], [pa.int64()] * 4 + [pa.bool_()]
    schema = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in kept)
    return media.mapInArrow(explode, f"{schema}, track long, timestamp_ns long, offset long, size long, keyframe boolean")


def read_back(media: DataFrame) -> DataFrame:
    """What the stored bytes hold: doc_id, n_bytes, the payload's and the file's length and digests, and a feature.

    A null file is an empty one; empty and damaged files give the payload of the packets that they hold
    whole. Each row gets a row; other columns are ignored; an empty table gives an empty result.
    """

    def decode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for m in part.column("media"):
                    stored = m.as_py() or b""
                    found = parse(stored)
                    payload = b"".join(stored[p.offset : p.offset + p.size] for p in found.packets)
                    rows.append(
                        (
                            len(payload),
                            hashlib.sha256(payload).hexdigest(),
                            zlib.crc32(payload[-PAD:]),
                            len(stored),
                            hashlib.sha256(stored).hexdigest(),
                            feature(payload, found),
                        )
                    )
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *columns], ["doc_id", "n_bytes", *names])

    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(decode, f"doc_id {kind}, n_bytes long, {schema}")


def op3_matroska(spark, sf_dir: str) -> DataFrame:
    return read_back(written(to_media(table(spark, sf_dir, "documents").select("doc_id", "text")), "media"))
