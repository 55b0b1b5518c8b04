"""Progressive JPEG: a decoder in numpy, and files that hold any bytes without loss.

The decoder follows ITU-T T.81, process SOF2: every scan, be it the first or a
refinement (successive approximation) of DC or of a band of AC coefficients
(spectral selection), adds to the coefficient arrays of its components. After the
last scan these are dequantised, inverse-transformed, put together to planes,
chroma is upsampled, and YCbCr becomes full-resolution RGB.

``pack`` writes bytes as such a file: each 64 bytes are the coefficients of one
block. Byte b stands for the coefficient b if b > 127, else b - 255: all of these
need eight magnitude bits, and the bits are those of b. The upper seven bits go
to the first scans, the last one to the refinements. Two thirds of the blocks are
luma, the rest chroma at half resolution.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmbridge.llm import common


def _zigzag() -> np.ndarray:
    """Row-major place of each coefficient in scan order: along the anti-diagonals, back and forth."""
    cells = [(i, j) for i in range(8) for j in range(8)]
    cells.sort(key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([i * 8 + j for i, j in cells])


ZIGZAG = _zigzag()


def _inverse() -> np.ndarray:
    """64 x 64: coefficients in scan order to samples in row-major order."""
    k, x = np.arange(8)[:, None], np.arange(8)[None, :]
    c = np.cos((2 * x + 1) * k * np.pi / 16) / 2
    c[0] /= np.sqrt(2)
    full = np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)
    return np.ascontiguousarray(full[ZIGZAG]).astype(np.float32)


INVERSE = _inverse()


class Component:
    def __init__(self, ident: int, h: int, v: int, table: int):
        self.ident, self.h, self.v, self.table = ident, h, v, table

    def lay(self, width: int, height: int, hmax: int, vmax: int) -> None:
        mw, mh = -(-width // (8 * hmax)), -(-height // (8 * vmax))
        #: blocks of the array, and those that scans of this component alone cover
        self.bw, self.bh = mw * self.h, mh * self.v
        self.own_w, self.own_h = -(-(-(-width * self.h // hmax)) // 8), -(-(-(-height * self.v // vmax)) // 8)
        self.coef = np.zeros((self.bw * self.bh, 64), np.int32)

    def own_order(self) -> np.ndarray:
        return (np.arange(self.own_h)[:, None] * self.bw + np.arange(self.own_w)).ravel()

    def mcu_order(self) -> np.ndarray:
        """(MCU, block within it): its places in the array."""
        rows, cols = np.arange(self.bh // self.v), np.arange(self.bw // self.h)
        y = rows[:, None, None, None] * self.v + np.arange(self.v)[None, None, :, None]
        x = cols[None, :, None, None] * self.h + np.arange(self.h)[None, None, None, :]
        return (y * self.bw + x).reshape(len(rows) * len(cols), self.h * self.v)


class Huffman:
    """Symbols by code length; ``lookup[16 bits]`` is length << 8 | symbol."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.symbols, self.lengths = symbols, [n for n, c in enumerate(counts, 1) for _ in range(c)]
        self._lookup: list[int] | None = None

    @property
    def lookup(self) -> list[int]:
        if self._lookup is None:
            table, code, before = np.zeros(1 << 16, np.int32), 0, 0
            for symbol, n in zip(self.symbols, self.lengths, strict=True):
                code <<= n - before
                table[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | symbol
                code, before = code + 1, n
            self._lookup = table.tolist()
        return self._lookup


def huffman(counts: bytes, symbols: bytes, _made={}) -> Huffman:  # noqa: B006
    key = counts + symbols
    if key not in _made:
        if len(_made) > 64:
            _made.clear()
        _made[key] = Huffman(counts, symbols)
    return _made[key]


class Bits:
    """One entropy-coded segment without stuffing. ``at`` is the next bit."""

    def __init__(self, data: bytes):
        self.data = data.replace(b"\xff\x00", b"\xff")
        self.at = 0
        self._wide: list[int] | None = None
        self._bits: np.ndarray | None = None

    @property
    def bits(self) -> np.ndarray:
        if self._bits is None:
            self._bits = np.unpackbits(np.frombuffer(self.data, np.uint8))
        return self._bits

    @property
    def wide(self) -> list[int]:
        """32 bits from each byte on; a read past the end sees ones."""
        if self._wide is None:
            b = np.frombuffer(self.data + b"\xff" * 8, np.uint8).astype(np.int64)
            self._wide = ((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]).tolist()
        return self._wide

    def take(self, n: int) -> int:
        if not n:
            return 0
        at = self.at
        self.at = at + n
        return self.wide[at >> 3] >> (32 - n - (at & 7)) & ((1 << n) - 1)

    def symbol(self, lookup: list[int]) -> int:
        at = self.at
        got = lookup[self.wide[at >> 3] >> (16 - (at & 7)) & 0xFFFF]
        if not got:
            raise ValueError("no such code")
        self.at = at + (got >> 8)
        return got & 255


def _value(bits: int, size: int) -> int:
    return bits if not size or bits >> (size - 1) else bits - (1 << size) + 1


class Decoder:
    """Parses one file; afterwards ``components`` hold the full coefficients."""

    def __init__(self, data: bytes):
        self.quant: dict[int, np.ndarray] = {}
        self.tables: dict[tuple[int, int], Huffman] = {}
        self.components: list[Component] = []
        self.comment: bytes | None = None
        self.restart = 0
        #: a block takes a bit of the first scan at least
        self.most_blocks = 8 * len(data)
        at = 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        while True:
            if data[at] != 0xFF:
                raise ValueError("no marker")
            kind = data[at + 1]
            if kind == 0xD9:
                break
            if kind == 0xFF:
                at += 1
                continue
            size = struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if kind == 0xDB:
                self._quantisation(body)
            elif kind == 0xC4:
                self._huffman(body)
            elif kind == 0xC2:
                self._frame(body)
            elif 0xC0 <= kind <= 0xCF and kind != 0xC8 and kind != 0xCC:
                raise ValueError("not a progressive file")
            elif kind == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif kind == 0xFE:
                self.comment = body
            elif kind == 0xDA:
                end = self._end(data, at)
                self._scan(body, data[at:end])
                at = end
        if not self.components:
            raise ValueError("no frame")

    @staticmethod
    def _end(data: bytes, at: int) -> int:
        """Where the entropy-coded data ends: the next marker other than a restart."""
        while True:
            at = data.find(b"\xff", at)
            if at < 0 or at + 1 >= len(data):
                raise ValueError("file ends in a scan")
            if data[at + 1] == 0 or 0xD0 <= data[at + 1] <= 0xD7:
                at += 2
            else:
                return at

    def _quantisation(self, body: bytes) -> None:
        at = 0
        while at < len(body):
            wide, n = body[at] >> 4, body[at] & 15
            size = 128 if wide else 64
            self.quant[n] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, at + 1).astype(np.int32)
            at += 1 + size

    def _huffman(self, body: bytes) -> None:
        at = 0
        while at < len(body):
            counts = body[at + 1 : at + 17]
            n = sum(counts)
            self.tables[body[at] >> 4, body[at] & 15] = huffman(counts, body[at + 17 : at + 17 + n])
            at += 17 + n

    def _frame(self, body: bytes) -> None:
        precision, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        if precision != 8 or not self.height or not self.width:
            raise ValueError("only 8-bit samples and a set size")
        self.components = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        self.hmax, self.vmax = max(c.h for c in self.components), max(c.v for c in self.components)
        if not self.hmax or not self.vmax or sum(-(-self.width * c.h // (8 * self.hmax)) * -(-self.height * c.v // (8 * self.vmax)) for c in self.components) > self.most_blocks:
            raise ValueError("a frame larger than the file can hold")
        for c in self.components:
            c.lay(self.width, self.height, self.hmax, self.vmax)

    def _scan(self, body: bytes, data: bytes) -> None:
        n = body[0]
        by_id = {c.ident: c for c in self.components}
        parts = [(by_id[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
        low, high, approx = body[1 + 2 * n : 4 + 2 * n]
        first, shift = approx >> 4 == 0, approx & 15
        if n > 1:
            orders = [c.mcu_order() for c, _, _ in parts]
        else:
            orders = [parts[0][0].own_order()[:, None]]
        units = len(orders[0])
        each = self.restart or units
        pieces = [data]
        if self.restart:
            pieces, at, begin = [], 0, 0
            while (at := data.find(b"\xff", at)) >= 0:
                if data[at + 1] != 0:
                    pieces.append(data[begin:at])
                    begin = at + 2
                at += 2
            pieces.append(data[begin:])
        for k, piece in enumerate(pieces):
            s = slice(k * each, min(units, (k + 1) * each))
            if s.start >= units:
                break
            bits = Bits(piece)
            if low == 0:
                if high:
                    raise ValueError("DC and AC in one scan of a progressive file")
                lists = [(c, self.tables.get((0, dc)), o[s]) for (c, dc, _), o in zip(parts, orders, strict=True)]
                (self._dc_first if first else self._dc_refine)(bits, lists, shift)
            else:
                c, _, ac = parts[0]
                (self._ac_first if first else self._ac_refine)(bits, c, self.tables[1, ac], orders[0][s, 0], low, high, shift)

    @staticmethod
    def _dc_first(bits: Bits, parts, shift: int) -> None:
        units = len(parts[0][2])
        looks = [t.lookup for _, t, o in parts for _ in range(o.shape[1])]
        owner = [k for k, (_, _, o) in enumerate(parts) for _ in range(o.shape[1])]
        before = [0] * len(parts)
        out: list[int] = []
        wide, at = bits.wide, bits.at
        plan = list(zip(looks, owner, strict=True))
        for _ in range(units):
            for look, k in plan:
                got = look[wide[at >> 3] >> (16 - (at & 7)) & 0xFFFF]
                at += got >> 8
                size = got & 255
                if size:
                    raw = wide[at >> 3] >> (32 - size - (at & 7)) & ((1 << size) - 1)
                    at += size
                    before[k] += raw if raw >> (size - 1) else raw - (1 << size) + 1
                elif not got:
                    raise ValueError("no such code")
                out.append(before[k])
        bits.at = at
        table = np.array(out, np.int32).reshape(units, -1) << shift
        col = 0
        for c, _, o in parts:
            c.coef[o, 0] = table[:, col : col + o.shape[1]]
            col += o.shape[1]

    @staticmethod
    def _dc_refine(bits: Bits, parts, shift: int) -> None:
        units, width = len(parts[0][2]), sum(o.shape[1] for _, _, o in parts)
        table = bits.bits[bits.at : bits.at + units * width].reshape(units, width).astype(np.int32) << shift
        bits.at += units * width
        col = 0
        for c, _, o in parts:
            c.coef[o, 0] |= table[:, col : col + o.shape[1]]
            col += o.shape[1]

    @staticmethod
    def _ac_first(bits: Bits, c: Component, table: Huffman, order: np.ndarray, low: int, high: int, shift: int) -> None:
        width = high - low + 1
        if len(table.symbols) == 1 and table.symbols[0] >> 4 == 0 and table.symbols[0] & 15:
            # one code, no runs: every coefficient takes the same number of bits
            size = table.symbols[0] & 15
            step, n = table.lengths[0] + size, len(order) * width
            if step == 8 and bits.at == 0:
                raw = np.frombuffer(bits.data, np.uint8, n).astype(np.int32) & ((1 << size) - 1)
            else:
                part = bits.bits[bits.at : bits.at + step * n].reshape(n, step)[:, table.lengths[0] :]
                raw = part.astype(np.int32) @ (1 << np.arange(size - 1, -1, -1))
            bits.at += step * n
            value = np.where(raw >> (size - 1), raw, raw - (1 << size) + 1).reshape(len(order), width)
            c.coef[order, low : high + 1] = np.sign(value) * (np.abs(value) << shift)
            return
        look, coef, run = table.lookup, c.coef, 0
        for block in order.tolist():
            if run:
                run -= 1
                continue
            k = low
            while k <= high:
                s = bits.symbol(look)
                zeros, size = s >> 4, s & 15
                if size:
                    k += zeros
                    coef[block, k] = _value(bits.take(size), size) * (1 << shift)
                    k += 1
                elif zeros == 15:
                    k += 16
                else:
                    run = (1 << zeros) + bits.take(zeros) - 1
                    break

    @staticmethod
    def _ac_refine(bits: Bits, c: Component, table: Huffman, order: np.ndarray, low: int, high: int, shift: int) -> None:
        look, coef, n = table.lookup, c.coef, 0
        bit = 1 << shift

        def correct(block: int, k: int) -> None:
            if bits.take(1):
                coef[block, k] += bit if coef[block, k] > 0 else -bit

        while n < len(order):
            block, k = int(order[n]), low
            run = 0
            while k <= high:
                s = bits.symbol(look)
                zeros, size = s >> 4, s & 15
                if not size and zeros < 15:
                    run = (1 << zeros) + bits.take(zeros)
                    break
                new = 0
                if size:
                    new = bit if bits.take(1) else -bit
                while k <= high:
                    if coef[block, k]:
                        correct(block, k)
                    elif zeros == 0:
                        if new:
                            coef[block, k] = new
                        k += 1
                        break
                    else:
                        zeros -= 1
                    k += 1
            if run:
                if k > low:
                    for j in range(k, high + 1):
                        if coef[block, j]:
                            correct(block, j)
                    n += 1
                    run -= 1
                # of whole blocks, only the coefficients that are set have a bit each
                blocks = order[n : n + run]
                band = coef[blocks, low : high + 1]
                set_before = band != 0
                count = int(np.count_nonzero(set_before))
                got = bits.bits[bits.at : bits.at + count]
                bits.at += count
                flat = band[set_before]
                band[set_before] = flat + np.where(flat > 0, bit, -bit) * got
                coef[blocks, low : high + 1] = band
                n += run
            else:
                n += 1

    def planes(self) -> list[np.ndarray]:
        """Samples of each component at its own resolution, 0 to 255."""
        out = []
        for c in self.components:
            samples = (c.coef * self.quant[c.table]).astype(np.float32) @ INVERSE
            samples += 128.5
            np.clip(samples, 0, 255.5, out=samples)
            out.append(samples.astype(np.uint8).reshape(c.bh, c.bw, 8, 8).transpose(0, 2, 1, 3).reshape(c.bh * 8, c.bw * 8))
        return out

    def rgb(self) -> np.ndarray:
        """height x width x 3. One component is grey; three are YCbCr; chroma samples are repeated."""
        full = []
        for c, p in zip(self.components, self.planes(), strict=True):
            ry, rx = self.vmax // c.v, self.hmax // c.h
            if rx > 1:
                p = np.repeat(p, rx, axis=1)
            if ry > 1:
                p = np.repeat(p, ry, axis=0)
            full.append(p[: self.height, : self.width])
        out = np.empty((self.height, self.width, 3), np.uint8)
        if len(full) < 3:
            out[:] = full[0][:, :, None]
            return out
        # 16-bit fixed point
        y = (full[0].astype(np.int32) << 16) + 32768
        cb, cr = full[1].astype(np.int32) - 128, full[2].astype(np.int32) - 128
        for k, v in enumerate((y + 91881 * cr, y - 22554 * cb - 46802 * cr, y + 116130 * cb)):
            v >>= 16
            np.clip(v, 0, 255, out=v)
            out[:, :, k] = v
        return out


def _segment(kind: int, body: bytes) -> bytes:
    return bytes((0xFF, kind)) + struct.pack(">H", len(body) + 2) + body


#: Tables of fixed-length codes: DC sizes 0-11 and runs of blocks, four bits each; and the one AC symbol, seven bits without a run.
_DC = bytes([0, 0, 0, 12, *[0] * 12]) + bytes(range(12))
_RUNS = bytes([0, 0, 0, 15, *[0] * 12]) + bytes(r << 4 for r in range(15))
_SEVEN = bytes([1, *[0] * 15, 7])
#: MCUs of a row at most: 16 samples each, below 65,536.
_ROW = 4095


def _scan_head(parts: list[tuple[int, int]], low: int, high: int, approx: int) -> bytes:
    return _segment(0xDA, bytes((len(parts),)) + b"".join(bytes(p) for p in parts) + bytes((low, high, approx)))


def _pad(bits: np.ndarray) -> bytes:
    more = -len(bits) % 8
    if more:
        bits = np.concatenate((bits, np.ones(more, np.uint8)))
    return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


def _dc_bits(value: np.ndarray) -> np.ndarray:
    """Codes of (unit, component part) differences: four bits of size, then the magnitude."""
    size = np.ceil(np.log2(np.abs(value) + 1)).astype(np.int64)
    word = (size << size) | np.where(value >= 0, value, value + (1 << size) - 1)
    length = size + 4
    ends = np.cumsum(length)
    of = np.repeat(np.arange(len(value)), length)
    return ((word[of] >> (ends[of] - 1 - np.arange(ends[-1]))) & 1).astype(np.uint8)


def pack(payload: bytes) -> bytes:
    """A progressive file whose coefficients hold ``payload``, a positive multiple of 64 bytes."""
    n = len(payload) // 64
    mcus = -(-n // 6)
    mw = min(mcus, _ROW)
    mh = -(-mcus // mw)
    if mh > _ROW:
        raise ValueError("too long for one file")
    m = mw * mh
    raw = np.zeros((6 * m, 64), np.uint8)
    raw[:n] = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    parts = [raw[: 4 * m], raw[4 * m : 5 * m], raw[5 * m :]]
    out = [b"\xff\xd8", _segment(0xFE, b"bytes:%d" % len(payload)), _segment(0xDB, b"\x00" + b"\x01" * 64)]
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, mh * 16, mw * 16, 3) + bytes((1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0))))
    out.append(_segment(0xC4, b"\x00" + _DC + b"\x10" + _SEVEN + b"\x11" + _RUNS))
    # DC, upper bits: differences in MCU order
    dc = np.where(raw[:, 0] > 127, raw[:, 0].astype(np.int64), raw[:, 0].astype(np.int64) - 255)
    luma = dc[: 4 * m].reshape(mh, 2, mw, 2).transpose(0, 2, 1, 3).reshape(m, 4)
    units = np.concatenate((luma, dc[4 * m : 5 * m, None], dc[5 * m :, None]), 1)
    top = units >> 1
    diff = np.empty_like(top)
    diff[:, :4] = np.diff(top[:, :4].ravel(), prepend=0).reshape(m, 4)
    diff[:, 4], diff[:, 5] = np.diff(top[:, 4], prepend=0), np.diff(top[:, 5], prepend=0)
    all_parts = [(1, 0), (2, 0), (3, 0)]
    out += [_scan_head(all_parts, 0, 0, 0x01), _pad(_dc_bits(diff.ravel()))]
    # AC, upper bits: a code of one bit, 0, and seven bits are one byte below 128
    for c, (part, bands) in enumerate(zip(parts, (((1, 9), (10, 63)), ((1, 63),), ((1, 63),)), strict=True), 1):
        for low, high in bands:
            out += [_scan_head([(c, 0)], low, high, 0x01), (part[:, low : high + 1] >> 1).tobytes()]
    # last bits, of magnitudes
    for c, part in enumerate(parts, 1):
        last = np.where(part[:, 1:] > 127, part[:, 1:], ~part[:, 1:]) & 1
        bits = []
        for a in range(0, len(last), 32767):
            some = last[a : a + 32767]
            r = len(some).bit_length() - 1
            head = f"{r:04b}" + (f"{len(some) - (1 << r):0{r}b}" if r else "")
            bits += [np.frombuffer(head.encode(), np.uint8) - 48, some.ravel()]
        out += [_scan_head([(c, 1)], 1, 63, 0x10), _pad(np.concatenate(bits))]
    out += [_scan_head(all_parts, 0, 0, 0x10), _pad((units & 1).astype(np.uint8).ravel()), b"\xff\xd9"]
    return b"".join(out)


def unpack(image: Decoder) -> bytes:
    """The payload of a file that pack() wrote."""
    n = int((image.comment or b"").removeprefix(b"bytes:"))
    coef = np.concatenate([c.coef for c in image.components])
    return np.where(coef > 0, coef, coef + 255).astype(np.uint8).tobytes()[:n]


#: Bytes of output after which a batch is handed on.
STEP = 16 << 20


def store_texts(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, n_bytes (long) and media (binary): each whole text as a progressive JPEG file.

    The text's UTF-8 bytes are filled with zero bytes to a positive multiple of
    64; a null text counts as empty. Equal texts give equal files. Columns of
    those two names are replaced.
    """
    common.tune(docs.sparkSession)
    keep = tuple(k for k in keep if k.lower() not in ("n_bytes", "media"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches):
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([len(t or b"") for t in texts], pa.int64()), pa.array([pack((t or b"").ljust(max(64, -(-len(t or b"") // 64) * 64), b"\0")) for t in texts], pa.binary())], names=[*keep, "n_bytes", "media"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "n_bytes bigint, media binary"]))


def decode_media(rows: DataFrame, payload: bool = True) -> DataFrame:
    """``rows`` with height, width (int), rgb (binary, row-major height x width x 3) and payload (binary) added.

    ``media`` is any progressive JPEG file; payload is null unless pack() wrote
    it and ``payload`` asks for it. A null or unreadable file, or one that
    declares more than its bytes can hold, gives nulls and the reason in
    ``error``. Columns of these five names are replaced.
    """
    common.tune(rows.sparkSession)
    rows = rows.drop("height", "width", "rgb", "payload", "error")
    names = rows.columns
    at = names.index("media")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "height int, width int, rgb binary, payload binary, error string"])

    def run(batches):
        for batch in batches:
            begin, got, size = 0, [], 0
            for n, media in enumerate(batch.column(at)):
                raw = media.as_py()
                row = (None, None, None, None, "no file")
                if raw is not None:
                    try:
                        image = Decoder(raw)
                        rgb = image.rgb()
                        row = (image.height, image.width, rgb.tobytes(), unpack(image) if payload and (image.comment or b"").startswith(b"bytes:") else None, None)
                    except (ValueError, KeyError, IndexError, struct.error, MemoryError) as e:
                        row = (None, None, None, None, str(e) or type(e).__name__)
                got.append(row)
                size += len(raw or b"") + len(row[2] or b"")
                if size >= STEP or n + 1 == batch.num_rows:
                    cols = list(zip(*got, strict=True))
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string())
                    part = batch.slice(begin, len(got))
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], names=[*names, "height", "width", "rgb", "payload", "error"])
                    begin, got, size = n + 1, [], 0

    return rows.mapInArrow(run, schema)


def store_tensors(rows: DataFrame, path: str) -> DataFrame:
    """Write what ``decode_media`` gives for ``rows`` to Parquet at ``path``, files aside, and read it again: height, width and rgb are full-resolution tensors."""
    decode_media(rows, payload=False).drop("media", "payload").write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def op3_media(spark, sf_dir) -> DataFrame:
    """Files are written to the shared folder and read again; of the tensors only digests are kept, as they take twice the texts' bytes."""
    stored = common.materialize(store_texts(common.documents(spark, sf_dir), "doc_id"), "media", compression="zstd")
    rows = decode_media(stored)
    return rows.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", F.concat_ws("x", "height", "width"), F.concat(F.lit("rgb:"), F.lower(F.lpad(F.hex(F.crc32("rgb")), 8, "0")))).alias("feature"),
    )
