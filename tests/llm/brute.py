"""Plain-Python models of the operators, one text at a time and all pairs, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def shingles(text: str | None) -> set[tuple]:
    words = SPACE_WORDS.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_duplicates(rows: list[tuple[int, str | None]], percent: int = 85) -> dict[int, tuple[int, int]]:
    """doc_id: (n_shingles, component_id)."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, sha256 of what is left."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, sha(bytes(b for b, g in zip(d, gone) if not g))))
    return out


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    text = text or ""
    out = []
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def listed(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = SPACE_WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def contamination(text: str | None, items: list[tuple[int, str | None]], window: int = 10) -> tuple[int, int, int, str]:
    words = ITEM_WORDS.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, said in items:
        w = ITEM_WORDS.findall((said or "").translate(LOWER))
        size = min(window, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == w[s:s + size]:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found)))
