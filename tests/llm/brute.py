"""Plain versions of the operators for small tables, written from their contracts."""

import math
import zlib

import xxhash

BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    out, word = [], []
    for c in text or "":
        if c in BLANKS:
            if word:
                out.append("".join(word))
            word = []
        else:
            word.append(c)
    return [*out, "".join(word)] if word else out


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text, shingle):
    w = words(ascii_lower(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(items, linked):
    """items: {key: value}. The smallest key that each key reaches over pairs that linked(value, value) accepts."""
    root = {k: k for k in items}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(items)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if linked(items[a], items[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k: top(k) for k in keys}


def repeated_bytes(texts, length):
    """For each text (bytes) the flags of bytes in a string of `length` bytes that starts at another place too."""
    seen = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            seen[t[s : s + length]] = seen.get(t[s : s + length], 0) + 1
    out = []
    for t in texts:
        flags = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                flags[s : s + length] = b"\1" * length
        out.append(flags)
    return out


def runs(flags):
    return sum(1 for k, f in enumerate(flags) if f and not (k and flags[k - 1]))


def distance(a, b):
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b, strict=True)))


def crc_mod(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m
