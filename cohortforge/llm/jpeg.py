"""Progressive JPEG: coefficient arrays from scans, pixels in numpy, and a lossless byte store.

``read`` accumulates the scans of a progressive file (spectral selection and
successive approximation, any Huffman tables, sampling factors and restart
intervals) into one coefficient array for each component; ``pixels`` transforms
them back, upsamples chroma and gives a full-resolution RGB tensor.

``store`` keeps bytes as quantised coefficients, the format's own unit: 64 bytes
are a block, three blocks (Y, Cb, Cr) a unit of 192 bytes.  Byte b becomes the
coefficient b (b >= 128) or b - 255 (b < 128), so all magnitudes fall into one
size class.  Scans: DC without its lowest bit, two AC bands without theirs, then
one refinement scan for DC and one for each component's AC.  Tables whose
symbols all take the same number of bits are decoded by array operations; other
files go through the general reader.  A very long payload wraps into rows of
units.  ``tensor_column`` stores the pixels of any progressive file as a column, and ``described`` takes features from it; for the
query the same pixels are described where they are made, so that they don't travel.  Null texts are empty ones; an empty text is 192 spaces.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import table

UNIT = 192
ROW_UNITS = 4096
DC_BITS = 11  # every DC difference takes this many bits, code and value together


def zigzag() -> np.ndarray:
    """Natural index of each zigzag position."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


ZIGZAG = zigzag()


def _basis() -> np.ndarray:
    """Rows: zigzag coefficients; columns: the 64 samples they add to."""
    k = np.arange(8)
    c = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)[:, None]
    return np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)[ZIGZAG].astype(np.float32)


BASIS = _basis()


# --- writing -------------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _stuffed(raw: bytes) -> bytes:
    return raw.replace(b"\xff", b"\xff\x00")


def _packed(words: np.ndarray, bits: int) -> bytes:
    """Values of a fixed number of bits one after another, filled up with ones."""
    flat = np.unpackbits(words.astype(">u2").view(np.uint8).reshape(-1, 2), axis=1)[:, 16 - bits :].ravel()
    return np.packbits(np.concatenate([flat, np.ones(-len(flat) % 8, np.uint8)])).tobytes()


def _dc_words() -> np.ndarray:
    """DC_BITS-bit words of the differences -255 to 255: a code of DC_BITS - size bits, then size bits."""
    out = np.zeros(511, np.int64)
    for diff in range(-255, 256):
        size = abs(diff).bit_length()
        out[diff + 255] = _dc_code(size) << size | (diff if diff >= 0 else diff + (1 << size) - 1)
    return out


def _dc_code(size: int) -> int:
    """The canonical code of a size, when sizes 8, 7, ... 0 have one code each of 3, 4, ... 11 bits."""
    code = 0
    for _ in range(8 - size):
        code = (code + 1) << 1
    return code


DC_WORDS = _dc_words()
DC_TABLE = bytes([0, 0, *[1] * 9, *[0] * 5]) + bytes(range(8, -1, -1))
FIRST_TABLE = bytes([1, *[0] * 15]) + b"\x07"
REFINE_TABLE = bytes([1, *[0] * 15]) + b"\x00"


def _scan(components, ss, se, ah, al, tables, data: bytes) -> bytes:
    head = bytes([len(components)]) + b"".join(bytes([c, t]) for c, t in zip(components, tables)) + bytes([ss, se, ah << 4 | al])
    return _segment(0xDA, head) + data


def store(payload: bytes, note: bytes = b"") -> bytes:
    """A progressive JPEG file whose coefficients are the payload (a positive multiple of 192 bytes)."""
    n = len(payload) // UNIT
    wide = min(n, ROW_UNITS)
    high = -(-n // wide)
    if high * 8 > 65535:
        raise ValueError("the payload is too long for one image")
    units = np.frombuffer(payload + b" " * (UNIT * (wide * high - n)), np.uint8).reshape(-1, 3, 64)
    dc = units[:, :, 0].astype(np.int64)
    dc = np.where(dc < 128, dc - 255, dc)
    low = dc & 1
    diff = np.diff(dc >> 1, axis=0, prepend=0)
    parts = [
        b"\xff\xd8",
        _segment(0xFE, b"payload %d " % len(payload) + note),
        _segment(0xDB, b"\x00" + b"\x01" * 64),
        _segment(0xC2, struct.pack(">BHHB", 8, high * 8, wide * 8, 3) + b"".join(bytes([c, 0x11, 0]) for c in (1, 2, 3))),
        _segment(0xC4, b"\x00" + DC_TABLE + b"\x10" + FIRST_TABLE),
        _scan((1, 2, 3), 0, 0, 0, 1, (0, 0, 0), _stuffed(_packed(DC_WORDS[diff + 255].ravel(), DC_BITS))),
    ]
    for first, last in ((1, 5), (6, 63)):
        for c in range(3):
            parts.append(_scan((c + 1,), first, last, 0, 1, (0,), _stuffed((units[:, c, first : last + 1] >> 1).tobytes())))
    parts.append(_scan((1, 2, 3), 0, 0, 1, 0, (0, 0, 0), _stuffed(_packed(low.ravel(), 1))))
    parts.append(_segment(0xC4, b"\x10" + REFINE_TABLE))
    for c in range(3):
        block = units[:, c, :]
        bits = (block ^ (block < 128)) & 1  # the lowest bit of the magnitude
        bits[:, 0] = 0  # the code of "no new coefficients"
        parts.append(_scan((c + 1,), 1, 63, 1, 0, (0,), _stuffed(np.packbits(bits.ravel()).tobytes())))
    return b"".join([*parts, b"\xff\xd9"])


# --- reading -------------------------------------------------------------------------------------


class Huffman:
    def __init__(self, counts: bytes, symbols: bytes):
        self.codes: dict[tuple[int, int], int] = {}
        self.lengths: dict[int, int] = {}
        code = at = 0
        for length in range(1, 17):
            for _ in range(counts[length - 1]):
                self.codes[length, code] = symbols[at]
                self.lengths[symbols[at]] = length
                code, at = code + 1, at + 1
            code <<= 1

    def only(self, symbol: int) -> bool:
        return self.lengths == {symbol: 1}

    def uniform(self) -> int:
        """Bits of code and value together, if they are the same for each DC size; else 0."""
        totals = {size + bits for size, bits in self.lengths.items()}
        return totals.pop() if len(totals) == 1 and max(self.lengths) <= 11 else 0


class Bits:
    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)).tolist()
        self.at = 0

    def one(self) -> int:
        self.at += 1
        return self.bits[self.at - 1] if self.at <= len(self.bits) else 0

    def many(self, n: int) -> int:
        value = 0
        for _ in range(n):
            value = value << 1 | self.one()
        return value

    def symbol(self, table: Huffman) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.one()
            if (length, code) in table.codes:
                return table.codes[length, code]
        raise ValueError("a Huffman code that the table lacks")

    def signed(self, size: int) -> int:
        value = self.many(size)
        return value if not size or value >> (size - 1) else value - (1 << size) + 1


class Component:
    def __init__(self, ident, h, v, quant):
        self.ident, self.h, self.v, self.quant = ident, h, v, quant

    def place(self, image, hmax, vmax):
        self.wide = -(-(-(-image.width * self.h // hmax)) // 8)
        self.high = -(-(-(-image.height * self.v // vmax)) // 8)
        self.full_wide, self.full_high = image.units_wide * self.h, image.units_high * self.v
        self.blocks = np.zeros((self.full_high * self.full_wide, 64), np.int32)


class Image:
    """Size, components with their coefficients (zigzag order), quantisers and comments."""

    def __init__(self):
        self.quant: dict[int, np.ndarray] = {}
        self.components: list[Component] = []
        self.comments: list[bytes] = []
        self.width = self.height = self.restart = self.units_wide = self.units_high = 0


def _entropy_end(data: bytes, at: int) -> int:
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            return len(data)
        if data[at + 1] and not 0xD0 <= data[at + 1] <= 0xD7:
            return at
        at += 2


def read(data: bytes, general: bool = False) -> Image:
    """The coefficients of a progressive JPEG file.  ``general``: never use array decoding."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    image, tables, at = Image(), {}, 2
    while at < len(data):
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        size = struct.unpack_from(">H", data, at + 2)[0]
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xFE:
            image.comments.append(body)
        elif marker == 0xDD:
            image.restart = struct.unpack(">H", body)[0]
        elif marker == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                image.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else "u1").astype(np.int32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = Huffman(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xC2:
            _, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            image.components = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            hmax, vmax = max(c.h for c in image.components), max(c.v for c in image.components)
            image.units_wide, image.units_high = -(-image.width // (8 * hmax)), -(-image.height // (8 * vmax))
            for c in image.components:
                c.place(image, hmax, vmax)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("not a progressive Huffman file")
        elif marker == 0xDA:
            end = _entropy_end(data, at)
            _read_scan(image, tables, body, data[at:end], general)
            at = end
    return image


def _read_scan(image: Image, tables, head: bytes, data: bytes, general: bool) -> None:
    n = head[0]
    by_id = {c.ident: c for c in image.components}
    chosen = [(by_id[head[1 + 2 * i]], tables.get(head[2 + 2 * i] >> 4), tables.get(0x10 | head[2 + 2 * i] & 15)) for i in range(n)]
    ss, se, ah, al = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
    if not general and not image.restart and all(c.h == c.v == 1 for c in image.components) and _read_array(chosen, ss, se, ah, al, data):
        return
    cuts, start = [], 0
    for i in range(len(data) - 1):
        if data[i] == 0xFF and 0xD0 <= data[i + 1] <= 0xD7:
            cuts.append(data[start:i])
            start = i + 2
    cuts.append(data[start:])
    if n == 1:
        c = chosen[0][0]
        units = [[(0, r * c.full_wide + k)] for r in range(c.high) for k in range(c.wide)]
    else:
        units = [
            [(i, (r * c.v + y) * c.full_wide + k * c.h + x) for i, (c, _, _) in enumerate(chosen) for y in range(c.v) for x in range(c.h)]
            for r in range(image.units_high)
            for k in range(image.units_wide)
        ]
    every = image.restart or len(units)
    for number, raw in enumerate(cuts):
        bits, last, run = Bits(raw), [0] * n, 0
        for unit in units[number * every : (number + 1) * every]:
            for i, at in unit:
                c, dc, ac = chosen[i]
                block = c.blocks[at]
                if ss == 0:
                    if ah:
                        block[0] |= bits.one() << al
                    else:
                        last[i] += bits.signed(bits.symbol(dc))
                        block[0] = last[i] << al
                elif ah == 0:
                    run = _ac_first(bits, ac, block, ss, se, al, run)
                else:
                    run = _ac_refine(bits, ac, block, ss, se, al, run)


def _ac_first(bits, table, block, ss, se, al, run) -> int:
    if run:
        return run - 1
    k = ss
    while k <= se:
        symbol = bits.symbol(table)
        zeros, size = symbol >> 4, symbol & 15
        if size:
            k += zeros
            block[k] = bits.signed(size) * (1 << al)
            k += 1
        elif zeros == 15:
            k += 16
        else:
            return (1 << zeros) + bits.many(zeros) - 1
    return 0


def _ac_refine(bits, table, block, ss, se, al, run) -> int:
    step, k = 1 << al, ss

    def correct(at):
        if bits.one():
            block[at] += step if block[at] > 0 else -step

    if not run:
        while k <= se:
            symbol = bits.symbol(table)
            zeros, size = symbol >> 4, symbol & 15
            if not size and zeros < 15:
                run = (1 << zeros) + bits.many(zeros)
                break
            value = (step if bits.one() else -step) if size else 0
            while k <= se:
                if block[k]:
                    correct(k)
                elif zeros:
                    zeros -= 1
                else:
                    block[k] = value
                    k += 1
                    break
                k += 1
    if run:
        for at in range(k, se + 1):
            if block[at]:
                correct(at)
        return run - 1
    return 0


def _read_array(chosen, ss, se, ah, al, data: bytes) -> bool:
    """Array decoding where each block takes the same number of bits; False if that isn't so."""
    n_blocks, n = len(chosen[0][0].blocks), len(chosen)
    if any(len(c.blocks) != n_blocks or c.full_wide != c.wide for c, _, _ in chosen):
        return False
    raw = np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)
    if ss == 0 and ah:
        low = np.unpackbits(raw, count=n_blocks * n).reshape(-1, n)
        for i, (c, _, _) in enumerate(chosen):
            c.blocks[:, 0] |= low[:, i].astype(np.int32) << al
        return True
    if ss == 0:
        bits = chosen[0][1].uniform() if all(t is chosen[0][1] for _, t, _ in chosen) else 0
        if not bits or bits > 16:
            return False
        flat = np.unpackbits(raw, count=n_blocks * n * bits).reshape(-1, bits)
        words = np.packbits(np.concatenate([np.zeros((len(flat), 16 - bits), np.uint8), flat], axis=1), axis=1).view(">u2").ravel()
        value = np.zeros(1 << bits, np.int32)
        for (length, code), size in chosen[0][1].codes.items():
            extra = np.arange(1 << size)
            value[(code << size) + extra] = np.where(extra >> max(size - 1, 0) > 0, extra, extra - (1 << size) + 1) if size else 0
        dc = np.cumsum(value[words].reshape(-1, n), axis=0)
        for i, (c, _, _) in enumerate(chosen):
            c.blocks[:, 0] = dc[:, i] << al
        return True
    c, _, ac = chosen[0]
    wide = se - ss + 1
    if ah == 0:
        size = next(iter(ac.lengths))
        if not (0 < size < 8 and ac.only(size)) or size != 7 or len(raw) != n_blocks * wide:
            return False
        extra = raw.reshape(-1, wide).astype(np.int32)
        c.blocks[:, ss : se + 1] = np.where(extra >= 64, extra, extra - 127) << al
        return True
    if not ac.only(0) or wide != 63 or not c.blocks[:, 1:].all() or len(raw) != n_blocks * 8:
        return False
    bits = np.unpackbits(raw).reshape(-1, 64)[:, 1:].astype(np.int32) << al
    part = c.blocks[:, 1:]
    part += np.where(part > 0, bits, -bits)
    return True


def planes(image: Image) -> list[np.ndarray]:
    """Each component's samples before upsampling, as float32 with the level shift undone."""
    out = []
    for c in image.components:
        samples = (c.blocks * image.quant[c.quant]).astype(np.float32) @ BASIS + np.float32(128)
        out.append(samples.reshape(c.full_high, c.full_wide, 8, 8).transpose(0, 2, 1, 3).reshape(c.full_high * 8, c.full_wide * 8))
    return out


def pixels(image: Image) -> np.ndarray:
    """The full-resolution RGB tensor (height, width, 3), uint8."""
    hmax, vmax = max(c.h for c in image.components), max(c.v for c in image.components)
    full = []
    for c, plane in zip(image.components, planes(image)):
        if (c.h, c.v) != (hmax, vmax):
            plane = plane.repeat(vmax // c.v, axis=0).repeat(hmax // c.h, axis=1)
        full.append(np.clip(np.rint(plane[: image.height, : image.width]), 0, 255))
    if len(full) == 1:
        full = [full[0], np.full_like(full[0], 128), np.full_like(full[0], 128)]
    y, cb, cr = full[0], full[1] - 128, full[2] - 128
    out = np.empty((*y.shape, 3), np.uint8)
    for i, channel in enumerate((y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb)):
        out[:, :, i] = np.clip(np.rint(channel), 0, 255)
    return out


def payload(image: Image) -> bytes:
    """The bytes that ``store`` has put into the coefficients."""
    n = int(image.comments[0].split()[1])
    units = np.stack([c.blocks for c in image.components], axis=1)
    return np.where(units < 0, units + 255, units).astype(np.uint8).tobytes()[:n]


def padded(text: bytes) -> bytes:
    return text + b" " * (-len(text) % UNIT if text else UNIT)


# --- columns -------------------------------------------------------------------------------------


def _encoder(names: list[str], text_col: str, media_col: str):
    def run(batches):
        for batch in batches:
            column = batch.column(names.index(text_col))
            _, off = B.utf8(column)
            for a, b in B.chunks(off, 1 << 20):
                texts = list(B.texts_of(column.slice(a, b - a)))
                media = [store(padded(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(list(map(len, texts)), pa.int64()), pa.array(media, pa.binary())], names=[*names, "n_bytes", media_col])

    return run


def encode_column(df: DataFrame, *, text_col="text", media_col="media") -> DataFrame:
    """``df`` with the padded UTF-8 text stored as a JPEG file in ``media_col``; n_bytes: unpadded bytes."""
    names = [c for c in df.columns if c not in (media_col, "n_bytes")]
    kept = df.select(*names)
    return kept.mapInArrow(_encoder(names, text_col, media_col), kept.withColumns({"n_bytes": F.lit(0).cast("long"), media_col: F.lit(None).cast("binary")}).schema)


def describe(tensor: np.ndarray) -> str:
    """Size and, for each channel, mean and mean absolute step to the right, in hundredths of whole numbers."""
    high, wide, _ = tensor.shape
    total = tensor.sum(axis=(0, 1), dtype=np.int64) * 100 // (high * wide)
    t = tensor.astype(np.int16)
    steps = np.abs(t[:, 1:] - t[:, :-1]).sum(axis=(0, 1), dtype=np.int64) * 100 // (high * (wide - 1))
    return f"{wide}x{high} mean {','.join(map(str, total))} step {','.join(map(str, steps))}"


_OUT = [("payload_bytes", pa.int64(), "long"), ("payload_sha256", pa.string(), "string"), ("tail_crc32", pa.int64(), "long"), ("media_bytes", pa.int64(), "long"), ("media_sha256", pa.string(), "string"), ("feature", pa.string(), "string")]


def _describer(names: list[str], rest: list[str], media_col: str):
    def run(batches):
        for batch in batches:
            column = batch.column(names.index(media_col))
            _, off = B.utf8(column)
            for a, b in B.chunks(off):
                rows = []
                for media in B.texts_of(column.slice(a, b - a)):
                    image = read(media)
                    held = payload(image)
                    rows.append((len(held), hashlib.sha256(held).hexdigest(), zlib.crc32(held[-16:]), len(media), hashlib.sha256(media).hexdigest(), describe(pixels(image))))
                cols = list(zip(*rows)) or [[]] * len(_OUT)
                yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)).slice(a, b - a) for c in rest), *(pa.array(v, t) for v, (_, t, _) in zip(cols, _OUT))], names=[*rest, *(n for n, *_ in _OUT)])

    return run


_TENSOR = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary())])


def _tensor_maker(names: list[str], media_col: str, into: str):
    def run(batches):
        for batch in batches:
            column = batch.column(names.index(media_col))
            _, off = B.utf8(column)
            for a, b in B.chunks(off, 1 << 20):
                part = column.slice(a, b - a)
                tensors = []
                for held, media in zip(part.is_valid().to_pylist(), B.texts_of(part)):
                    tensor = pixels(read(media)) if held else None
                    tensors.append(None if tensor is None else {"height": tensor.shape[0], "width": tensor.shape[1], "channels": 3, "data": tensor.astype(np.uint8).tobytes()})
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(tensors, _TENSOR)], names=[*names, into])

    return run


def tensor_column(df: DataFrame, *, media_col="media", into="tensor") -> DataFrame:
    """``df`` with each file's full-resolution RGB pixels as a column to store: height, width, channels and bytes in rows; null files give null."""
    kept = df.drop(into)
    schema = kept.withColumn(into, F.lit(None).cast("struct<height:int,width:int,channels:int,data:binary>")).schema
    return kept.mapInArrow(_tensor_maker(kept.columns, media_col, into), schema)


def described(df: DataFrame, *, tensor_col="tensor", into="feature") -> DataFrame:
    """``df`` with the pixel features of a stored tensor column."""
    kept = df.drop(into)
    names = kept.columns

    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column(names.index(tensor_col)).to_pylist():
                out.append(None if t is None else describe(np.frombuffer(t["data"], np.uint8).reshape(t["height"], t["width"], t["channels"])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, into])

    return kept.mapInArrow(run, kept.withColumn(into, F.lit(None).cast("string")).schema)


def feature_columns(df: DataFrame, *, media_col="media") -> DataFrame:
    """``df`` without ``media_col``, with what the stored bytes hold: payload digests and pixel features."""
    kept = df.drop(*(n for n, *_ in _OUT))
    rest = [c for c in kept.columns if c != media_col]
    return kept.mapInArrow(_describer(kept.columns, rest, media_col), kept.select(*rest, *(F.lit(None).cast(s).alias(n) for n, _, s in _OUT)).schema)


def round_trip(df: DataFrame, *, text_col="text") -> DataFrame:
    """``encode_column`` and ``feature_columns`` in one pass, the text left out: files stay in one worker."""
    names = [c for c in df.columns if c not in ("media", "n_bytes", *(n for n, *_ in _OUT))]
    kept = df.select(*names)
    rest = [c for c in [*names, "n_bytes"] if c != text_col]
    write, look = _encoder(names, text_col, "media"), _describer([*names, "n_bytes", "media"], rest, "media")
    done = kept.withColumn("n_bytes", F.lit(0).cast("long")).select(*rest, *(F.lit(None).cast(s).alias(n) for n, _, s in _OUT))
    return kept.mapInArrow(lambda batches: look(write(batches)), done.schema)


def query(spark, sf_dir) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
