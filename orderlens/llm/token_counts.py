"""Token counts by a compiled finite-state tokenizer: nothing is tokenized, a transducer over code points counts.

A byte-level BPE (public JSON file) with its splitting pattern becomes a deterministic transducer. Each transition carries how
many tokens the text has more, were it to end there, than one code point earlier; the sum over a text is its number of tokens.

* Inside a piece of the pattern, the last token at a place is the one whose predecessor's last token may stand before it: two
  tokens may be neighbours if no merge across their border comes before the merges that made them. Only places within the
  longest suffix that still begins some token matter, so a state is that suffix with the last token and the relative count at each of its places.
* Around that stand the pattern's states: runs of letters, numbers, others, white space (its last character may still go over
  to the next piece), and an apostrophe that may become a contraction.

There are too many states to list and few in use, so they are compiled when a text first reaches them and kept for later texts
of the same worker process, up to MOST_STATES and MOST_TRANSITIONS; beyond, the table is started again. Results don't depend on it.

Texts are cut into chunks of CHUNK code points, which step through the table side by side, as one array of states. A chunk's
state map is constant from its first certain border on (white space after something else): whatever state comes in, the
same state goes out. Only the stretch before that border (all of the chunk, if there is none) depends on the incoming state.
The maps are composed by a parallel prefix scan, pairwise up a tree and down again, which gives every chunk the state it
starts in; then all first stretches run side by side. Long texts are blocks of the same scan, with the state handed on.

Cases: a null or empty text has 0 bytes and 0 tokens. The vocabulary's special strings count as one token and end what is before
them, as in the library. Repeated rows are counted each for itself, and no two rows meet. An empty table gives an empty
result. Of other columns only doc_id is read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches
from .tokens import _byte_letters, public_path, shipped

VOCABULARY = "byte_bpe_50k.json"
#: Code points that step as one lane, and that are in memory at a time (as arrays).
CHUNK, BLOCK = 256, 1 << 18
#: Where the transducer's table is started again, between blocks.
MOST_STATES, MOST_TRANSITIONS = 300_000, 900_000
#: So few lanes step faster one by one.
FEW_LANES = 24
FRESH = 0
_HALF = 1 << 15
#: The pattern's contractions, and Unicode's white space.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"


class Merges:
    """A byte-level BPE's vocabulary and merges, from its JSON file."""

    def __init__(self, content: bytes):
        model = json.loads(content)
        kind, splitter = model["model"], model.get("pre_tokenizer") or {}
        if kind.get("type") != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True) \
                or model.get("normalizer") or kind.get("dropout") or kind.get("ignore_merges") or kind.get("continuing_subword_prefix") or kind.get("end_of_word_suffix"):
            raise ValueError("only a plain byte-level BPE with the usual splitting pattern can be compiled")
        added = model.get("added_tokens", [])
        if any(x[flag] for x in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take in their surroundings cannot be compiled")
        self.special = [x["content"].encode() for x in added]
        letters = _byte_letters()
        spelled = lambda token: bytes(letters[c] for c in token)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in kind["merges"]]
        self.ranks = {(spelled(a), spelled(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in self.ranks}
        if len(self.parts) != len(self.ranks):
            raise ValueError("two merges make the same token")
        # a token that its own merges do not lead to is never given out
        self.tokens = {bytes([b]) for b in range(256)} | {t for t in self.parts if self.merged(t) == [t]}

    def merged(self, piece: bytes) -> list[bytes]:
        """The tokens of one piece, merge by merge."""
        out = [bytes([b]) for b in piece]
        while len(out) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(out, out[1:])))
            if rank == len(self.ranks):
                break
            out[at:at + 2] = [out[at] + out[at + 1]]
        return out


class Transducer:
    """The compiled tokenizer; what it has compiled stays with the object, not with its pickle."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.ready = False

    def __getstate__(self):
        return {"merges": self.merges, "ready": False}

    def _prepare(self) -> None:
        merges = self.merges
        self.tokens, self.ranks, self.parts = merges.tokens, merges.ranks, merges.parts
        self.beginnings = {t[:n]: t[:n] for t in self.tokens for n in range(1, len(t) + 1)}
        self.places: dict[tuple, tuple] = {}  # equal (token, count) share one object
        self.neighbours: dict[tuple[bytes, bytes], bool] = {}
        self.spines: dict[tuple[bytes, int], list] = {}
        self.white = np.zeros(0x110000, dtype=bool)
        self.white[[ord(c) for c in WHITE_SPACE]] = True
        self.contracted = {c: self._piece(c.encode())[1] for c in CONTRACTIONS}
        self._clear()
        self.ready = True

    def _clear(self) -> None:
        self.states: list[tuple] = [("fresh",)]
        self.numbers: dict[tuple, int] = {("fresh",): FRESH}
        self.transitions: dict[int, int] = {}
        self.table = Table()

    # --- compiling: one transition

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The pieces at one edge of a token while it is made, each with the rank of the merge that takes it in."""
        if (spine := self.spines.get((token, side))) is None:
            spine, piece = [(token, float("inf"))], token
            while len(piece) > 1:
                pair = self.parts[piece]
                piece = pair[side]
                spine.append((piece, self.ranks[pair]))
            self.spines[token, side] = spine
        return spine

    def _may_meet(self, before: bytes, after: bytes) -> bool:
        """Whether the two tokens stay as they are side by side: no merge of facing pieces comes before theirs."""
        known = self.neighbours.get((before, after))
        if known is None:
            ranks, known = self.ranks, True
            for x, x_goes in self._spine(before, 1):
                for y, y_goes in self._spine(after, 0):
                    rank = ranks.get((x, y))
                    # of equal merges the leftmost comes first
                    if rank is not None and rank < x_goes and rank <= y_goes:
                        known = False
            self.neighbours[before, after] = known
        return known

    def _bytes(self, inner: tuple, data: bytes) -> tuple[tuple, int]:
        """The state inside a piece after more bytes, and how many tokens are added.

        A state is (suffix, last tokens and relative counts at the places from before the suffix up to here).
        """
        suffix, places = inner
        added, same = 0, self.places
        for byte in data:
            longer = suffix + bytes([byte])
            for start in range(len(longer)):
                token = longer[start:]
                if token in self.tokens:
                    before, relative = places[start]
                    if before is None or self._may_meet(before, token):
                        break
            more = relative + 1
            cut = 0
            while longer[cut:] not in self.beginnings:
                cut += 1
            suffix = self.beginnings[longer[cut:]]
            places = (*[same.setdefault(p, p) for p in [(t, c - more) for t, c in places[cut:]]], same.setdefault((token, 0), (self.beginnings[token], 0)))
            added += more
        return (suffix, places), added

    def _piece(self, data: bytes) -> tuple[tuple, int]:
        return self._bytes((b"", ((None, 0),)), data)

    def _begin(self, char: str, group: str) -> tuple[tuple, int]:
        """A new piece begins."""
        inner, added = self._piece(char.encode())
        if group == "space":
            return ("space", char == " ", added, -added, inner), added
        if char == "'":
            return ("apostrophe",), added
        return (group, inner), added

    def _after(self, state: tuple, char: str) -> tuple[tuple, int]:
        """The next state, and how many tokens more the text has."""
        group, kind, data = grouped(char), state[0], char.encode()
        if kind == "space":
            _, blank, alone, back, inner = state
            if group == "space":
                inner, added = self._bytes(inner, data)
                return ("space", char == " ", self._piece(data)[1], -added, inner), added
            if blank:  # the run's last blank goes over to the next piece
                inner, added = self._piece(b" " + data)
                return (group, inner), back + added
            state, added = self._begin(char, group)
            return state, back + alone + added
        if kind == "apostrophe":
            if "'" + char in self.contracted:
                return ("fresh",), self.contracted["'" + char] - 1
            if group == "other":
                inner, added = self._piece(b"'" + data)
                return (group, inner), added - 1
            if any(c.startswith("'" + char) for c in CONTRACTIONS):
                inner, added = self._piece(data)
                return ("contraction", char, inner, added), added
            return self._begin(char, group)
        if kind == "contraction":
            _, first, inner, earlier = state
            if (whole := "'" + first + char) in self.contracted:
                return ("fresh",), self.contracted[whole] - 1 - earlier
            kind, state = "letter", ("letter", inner)
        if kind == group:
            inner, added = self._bytes(state[1], data)
            return (kind, inner), added
        return self._begin(char, group)

    def _compiled(self, key: int) -> int:
        found = self.transitions.get(key)
        if found is None:
            state, added = self._after(self.states[key >> 21], chr(key & 0x1FFFFF))
            found = self.transitions[key] = self._number(state) << 16 | (added + _HALF)
        return found

    def _number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number

    # --- running: many lanes at a time

    def _steps(self, keys: np.ndarray) -> np.ndarray:
        values, missing = self.table.find(keys)
        if len(missing):
            new = np.unique(keys[missing])
            self.table.insert(new, np.array([self._compiled(k) for k in new.tolist()], dtype=np.int64))
            values[missing] = self.table.find(keys[missing])[0]
        return values

    def _run(self, codes: np.ndarray, states: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states and added tokens of lanes that read codes[starts:ends] from their states."""
        order = np.argsort(starts - ends, kind="stable")
        state, at, size = states[order], starts[order], (ends - starts)[order]
        added = np.zeros(len(order), dtype=np.int64)
        running = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right").tolist()
        for step, lanes in enumerate(running):
            if lanes < FEW_LANES:
                for lane in range(lanes):
                    s, n, get = int(state[lane]), 0, self._compiled
                    for code in codes[at[lane] + step:at[lane] + size[lane]].tolist():
                        value = get(s << 21 | code)
                        s = value >> 16
                        n += (value & 0xFFFF) - _HALF
                    state[lane] = s
                    added[lane] += n
                break
            values = self._steps(state[:lanes] << 21 | codes[at[:lanes] + step])
            state[:lanes] = values >> 16
            added[:lanes] += (values & 0xFFFF) - _HALF
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return state[back], added[back]

    def _scan(self, codes: np.ndarray, leaving: np.ndarray, starts: np.ndarray, ends: np.ndarray, entering: int) -> np.ndarray:
        """The state each chunk starts in, by composing state maps up a tree and handing states down it.

        leaving: the state in which a chunk ends whatever comes in, or -1 where that depends on what comes in.
        """
        if len(leaving) == 1:
            return np.array([entering])
        left, right = leaving[0:-1:2], leaving[1::2]
        whole = right.copy()  # of two neighbours: the right one's constant, or what the left one's leads to
        onward = np.flatnonzero((right < 0) & (left >= 0))
        if len(onward):
            whole[onward] = self._run(codes, left[onward], starts[1::2][onward], ends[1::2][onward])[0]
        odd = len(leaving) % 2
        level = self._scan(codes, np.append(whole, leaving[-1:]) if odd else whole, starts[::2],
                           np.append(ends[1::2], ends[-1:]) if odd else ends[1::2], entering)
        states = np.empty(len(leaving), dtype=np.int64)
        states[::2] = level
        into_right = left.copy()
        open_ = np.flatnonzero(left < 0)
        if len(open_):
            into_right[open_] = self._run(codes, level[:len(left)][open_], starts[0:-1:2][open_], ends[0:-1:2][open_])[0]
        states[1::2] = into_right
        return states

    def block(self, codes: np.ndarray, begins: np.ndarray, entering: tuple) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(chunk starts, added tokens per chunk, last state) of code points in which texts begin at places `begins`."""
        if not self.ready:
            self._prepare()
        if len(self.states) > MOST_STATES or len(self.transitions) > MOST_TRANSITIONS:
            self._clear()
        first = self._number(entering)
        edges = [0, *[b for b in begins.tolist() if b], len(codes)]
        starts = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(edges, edges[1:])])
        ends = np.append(starts[1:], len(codes))
        white = self.white[codes]
        certain = np.zeros(len(codes), dtype=bool)
        certain[1:] = white[1:] & ~white[:-1]
        certain[begins] = True
        borders = np.append(np.flatnonzero(certain), len(codes))
        border = np.minimum(borders[np.searchsorted(borders, starts)], ends)
        leaving, added = self._run(codes, np.full(len(starts), FRESH), border, ends)
        entry = self._scan(codes, np.where(border < ends, leaving, -1), starts, ends, first)
        # texts begin anew whatever was before them
        state, more = self._run(codes, entry, starts, border)
        last = leaving[-1] if border[-1] < ends[-1] else state[-1]
        return starts, added + more, self.states[int(last)]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Numbers of tokens of UTF-8 texts."""
        total = np.zeros(len(texts), dtype=np.int64)
        codes, owners, begins, held, state = [], [], [], 0, ("fresh",)

        def close() -> None:
            nonlocal codes, owners, begins, held, state
            if held:
                starts, added, state = self.block(np.concatenate(codes), np.array(begins, dtype=np.int64), state)
                at, rows = (np.array(x) for x in zip(*owners))
                np.add.at(total, rows[np.searchsorted(at, starts, side="right") - 1], added)
            codes, owners, begins, held = [], [], [], 0

        for row, text in enumerate(texts):
            segments = [text]
            for special in self.merges.special:
                segments = [part for segment in segments for part in segment.split(special)]
            total[row] += len(segments) - 1
            for segment in segments:
                for new, part in pieces(segment, BLOCK):
                    if held and held + len(part) > BLOCK:
                        close()
                    if new:
                        begins.append(held)
                    owners.append((held, row))
                    codes.append(part)
                    held += len(part)
        close()
        return total


class Table:
    """Transitions by (state, code point) as numpy arrays: a hash table with open addressing that finds many keys at once."""

    _MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, bits: int = 16):
        self.bits, self.count = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self._MULTIPLIER >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the places of keys that are not there."""
        slots, missing = self._slots(keys), []
        held = self.keys[slots]
        values = self.values[slots]
        left = np.flatnonzero(held != keys)
        while len(left):
            absent = self.keys[slots[left]] < 0
            missing.append(left[absent])
            left = left[~absent]
            slots[left] = slots[left] + 1 & (1 << self.bits) - 1
            here = self.keys[slots[left]] == keys[left]
            values[left[here]] = self.values[slots[left[here]]]
            left = left[~here]
        return values, np.concatenate(missing) if missing else left

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            used = self.keys >= 0
            old = self.keys[used], self.values[used]
            self.__init__(max(self.bits + 1, (4 * (self.count + len(keys))).bit_length()))
            self.insert(*old)
        self.count += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], slots[~placed] + 1 & (1 << self.bits) - 1


def grouped(char: str) -> str:
    """The pattern's group of a character."""
    if char in WHITE_SPACE:
        return "space"
    return {"L": "letter", "N": "number"}.get(unicodedata.category(char)[0], "other")


def pieces(text: bytes, size: int) -> Iterator[tuple[bool, np.ndarray]]:
    """Code points of a text, in parts of at most `size` bytes; whether a part is the text's first."""
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        codes = np.frombuffer(text[start:end].decode(errors="replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        yield start == 0, codes
        start = end


def _count(shared, limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            n = shared.value.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return count


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of docs(doc_id, text) by a byte-level BPE's JSON file."""
    spark = docs.sparkSession
    content = shipped(spark, path or public_path(VOCABULARY))
    shared = spark.sparkContext.broadcast(Transducer(Merges(content.value)))
    content.unpersist()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_count(shared, limit), f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
