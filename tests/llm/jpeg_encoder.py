"""A plain progressive encoder, one bit at a time, to hold the decoder against."""

import struct

from ohmbridge.llm.jpeg import _DC, _segment


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [(value >> (n - 1 - i)) & 1 for i in range(n)]

    def bytes(self):
        b = self.bits + [1] * (-len(self.bits) % 8)
        return bytes(int("".join(map(str, b[i : i + 8])), 2) for i in range(0, len(b), 8)).replace(b"\xff", b"\xff\x00")


#: Codes of uneven length for all AC symbols: 3 of four bits, 12 of six, 160 of nine, 81 of ten; none is all ones.
SYMBOLS = [0x00, 0x01, 0x11, *(s for s in range(256) if s not in (0x00, 0x01, 0x11))]
COUNTS = [0, 0, 0, 3, 0, 12, 0, 0, 160, 81, 0, 0, 0, 0, 0, 0]
CODES, code, at = {}, 0, 0
for length, count in enumerate(COUNTS, 1):
    for _ in range(count):
        CODES[SYMBOLS[at]] = (code, length)
        code, at = code + 1, at + 1
    code <<= 1


def size_of(v):
    return abs(v).bit_length()


def magnitude(w, v, n):
    w.put(v if v >= 0 else v + (1 << n) - 1, n)


def shifted(v, al):
    return v >> al if v >= 0 else -(-v >> al)


def dc_scan(parts, al, ah):
    w, before = Writer(), [0] * len(parts)
    for unit in range(len(parts[0][1])):
        for k, (coef, order) in enumerate(parts):
            for block in order[unit]:
                v = int(coef[block][0])
                if ah:
                    w.put(v >> al & 1, 1)
                    continue
                d = (v >> al) - before[k]
                before[k] = v >> al
                w.put(size_of(d), 4)
                magnitude(w, d, size_of(d))
    return w.bytes()


def flush_run(w, run, kept):
    if run:
        n = run.bit_length() - 1
        w.put(*CODES[n << 4])
        w.put(run - (1 << n), n)
    for b in kept:
        w.put(b, 1)


def ac_first(coef, order, low, high, al):
    w, run = Writer(), 0
    for block in order:
        zeros = 0
        vals = [shifted(int(coef[block][k]), al) for k in range(low, high + 1)]
        last = max((k for k, v in enumerate(vals) if v), default=-1)
        for k in range(last + 1):
            if not vals[k]:
                zeros += 1
                continue
            flush_run(w, run, [])
            run = 0
            while zeros > 15:
                w.put(*CODES[0xF0])
                zeros -= 16
            n = size_of(vals[k])
            w.put(*CODES[zeros << 4 | n])
            magnitude(w, vals[k], n)
            zeros = 0
        if last < high - low:
            run += 1
            if run == 32767:
                flush_run(w, run, [])
                run = 0
    flush_run(w, run, [])
    return w.bytes()


def ac_refine(coef, order, low, high, al):
    w, run, waiting = Writer(), 0, []
    for block in order:
        vals = [abs(int(coef[block][k])) >> al for k in range(low, high + 1)]
        last_new = max((k for k, v in enumerate(vals) if v == 1), default=-1)
        zeros, bits = 0, []
        for k, v in enumerate(vals):
            if k > last_new:
                if v:
                    bits.append(v & 1)
                continue
            if v == 0:
                zeros += 1
                if zeros == 16:
                    flush_run(w, run, waiting)
                    run, waiting = 0, []
                    w.put(*CODES[0xF0])
                    for b in bits:
                        w.put(b, 1)
                    bits, zeros = [], 0
                continue
            if v > 1:
                bits.append(v & 1)
                continue
            flush_run(w, run, waiting)
            run, waiting = 0, []
            w.put(*CODES[zeros << 4 | 1])
            w.put(1 if coef[block][low + k] > 0 else 0, 1)
            for b in bits:
                w.put(b, 1)
            bits, zeros = [], 0
        if last_new < high - low:
            run += 1
            waiting += bits
            if run == 32767:
                flush_run(w, run, waiting)
                run, waiting = 0, []
    flush_run(w, run, waiting)
    return w.bytes()


def encode(image, quant):
    """``image``: a Decoder's frame with filled components; the scans cut bands and bits in several ways."""
    out = [b"\xff\xd8", _segment(0xDB, b"\x00" + bytes(quant))]
    body = struct.pack(">BHHB", 8, image.height, image.width, len(image.components))
    out.append(_segment(0xC2, body + b"".join(bytes((c.ident, c.h << 4 | c.v, 0)) for c in image.components)))
    out.append(_segment(0xC4, b"\x00" + _DC + b"\x10" + bytes(COUNTS) + bytes(SYMBOLS)))

    def scan(parts, low, high, ah, al, data):
        out.append(_segment(0xDA, bytes((len(parts),)) + b"".join(bytes((c.ident, 0)) for c in parts) + bytes((low, high, ah << 4 | al))) + data)

    many = len(image.components) > 1
    orders = [(c.coef, c.mcu_order() if many else c.own_order()[:, None]) for c in image.components]
    scan(image.components, 0, 0, 0, 1, dc_scan(orders, 1, 0))
    for c in image.components:
        own = c.own_order()
        for low, high in ((1, 5), (6, 63)):
            scan([c], low, high, 0, 2, ac_first(c.coef, own, low, high, 2))
        for ah, al in ((2, 1), (1, 0)):
            scan([c], 1, 63, ah, al, ac_refine(c.coef, own, 1, 63, al))
    scan(image.components, 0, 0, 1, 0, dc_scan(orders, 0, 1))
    return b"".join(out) + b"\xff\xd9"
