"""Plain forms of the operators, one text or one small table at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def quality(text: str | None) -> dict:
    text = text or ""
    words, seen = WORD.findall(text), set()
    lines = text.split("\n")
    dup = 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words)}


def fingerprint(text: str | None, width: int = 3) -> int:
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    grams = [words] if len(words) < width else [
        words[i:i + width] for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs: list[tuple], width: int = 3, bits: int = 2) -> list[tuple]:
    prints = [(i, fingerprint(t, width)) for i, t in docs]
    distinct = sorted({p for _, p in prints})
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for n, a in enumerate(distinct):
        for b in distinct[n + 1:]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root(p)] = min(i, least.get(root(p), i))
    return sorted(((i, f"{p:016x}", least.get(root(p))) for i, p in prints), key=str)


def line_dedup(docs: list[tuple]) -> list[tuple]:
    def last(i):
        return (i is None, i or 0)

    first = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            key = ascii_lower(line.strip(SPACES))
            if len(key) >= 10:
                first[key] = min(first.get(key, last(i)), last(i))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(
            ascii_lower(x.strip(SPACES)), last(i)) == last(i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(out, key=str)


def warc(pages: list[tuple]) -> list[tuple]:
    first = {}
    for i, html in pages:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, html in pages:
        data = (html or "").encode()
        revisit = data in first and i != first[data]
        out.append((i, len(data), sha(data), "revisit" if revisit else "response",
                    first[data] if revisit else None))
    return sorted(out, key=str)


def repeated_bytes(docs: list[tuple], width: int = 50) -> list[tuple]:
    first, out = defaultdict(lambda: None), []

    def last(i):
        return (i is None, i or 0)

    for i, text in docs:
        data = (text or "").encode()
        for s in range(len(data) - width + 1):
            w = data[s:s + width]
            if first[w] is None or last(i) < first[w]:
                first[w] = last(i)
    for i, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - width + 1):
            if first[data[s:s + width]] < last(i):
                gone[s:s + width] = b"\1" * width
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), spans,
                    sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=str)
