"""Token counts by finite-state tokenizer compilation.

The tokenizer file is compiled into two deterministic transducers.

* The *splitter* reads the normalised text by characters (``CLASSES``) and marks
  where pieces begin.  Its ``STATES`` are few, so a stretch of text is a state
  map: end state by start state.  All texts of a slice lie one after another and
  are cut into equal chunks, wherever a text ends; every chunk's map is built by
  table look-ups, the maps compose through a parallel prefix scan (doubling
  distances), and with each chunk's true start state a second sweep reads the
  marks off the transitions.
* The *piece counter* reads a piece by bytes.  Its transitions carry the number
  of tokens that are certain by then, its final arcs (the byte that ends a
  piece) the rest.  A state is what the rest of a piece can depend on: the
  longest suffix that may begin a token, and for each place in it the last token
  of the merge result up to there with its relative count.  A token follows
  another exactly if merging the two alone keeps both, so the last token of
  every prefix is unique and the state is deterministic.  States and arcs are
  built when first met and kept in bounded tables; so are pieces, as arcs of
  their own.

Byte classes, normal forms and merges are read from the file through its
library, which never tokenizes here.  Counting is row-local: no shuffle, no
collect, and the executors need no vocabulary file.

Supported files: byte-level BPE with an end-of-word suffix, split by
contractions, letters, single digits and other signs, white space dropped
(``word_bpe_49k.json``); anything else is refused.

Defined cases: a null text is empty; an empty or blank text has no tokens; the
strings of added special tokens count as one each; a very long text is read in
parts that end at white space; a null doc_id is kept; repeated rows count each;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
PART_BYTES, CHUNK_BYTES = 4 << 20, 256
MOST_STATES, MOST_PIECES = 200_000, 500_000
#: The one split rule that is compiled (fixed value of the file).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: From here on a character may combine with others.
LATE = re.compile("[\u0300-\U0010ffff]")

SPACE, DIGIT, LETTER, ENDS, R_V, L, E, MARK, OTHER, INSIDE = range(10)  # classes; ENDS: d m s t; INSIDE: a character's further bytes
FRESH, WORD, SIGNS, QUOTE, QUOTE_RV, QUOTE_L = range(6)  # states
HERE, BEFORE = 1, 2  # a piece begins at this byte, at the byte before
CLASSES, STATES = 10, 6


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[class, state] and marks[class, state]."""
    to, marks = np.zeros((CLASSES, STATES), np.uint8), np.zeros((CLASSES, STATES), np.uint8)
    begun = {SPACE: (FRESH, 0), DIGIT: (FRESH, HERE), MARK: (QUOTE, HERE), OTHER: (SIGNS, HERE),
             **{c: (WORD, HERE) for c in (LETTER, ENDS, R_V, L, E)}}
    for c, (state, mark) in begun.items():
        to[c, :], marks[c, :] = state, mark
        # an undecided contraction that is none: its letter begins a word, in which this byte comes next
        for s in (QUOTE_RV, QUOTE_L):
            marks[c, s] |= BEFORE
    for s in (WORD, QUOTE_RV, QUOTE_L):  # a word goes on
        for c in (LETTER, ENDS, R_V, L, E):
            to[c, s], marks[c, s] = WORD, 0 if s == WORD else BEFORE
    for s in (SIGNS, QUOTE):
        for c in (MARK, OTHER):
            to[c, s], marks[c, s] = SIGNS, 0
    for c, s, state in ((ENDS, QUOTE, FRESH), (R_V, QUOTE, QUOTE_RV), (L, QUOTE, QUOTE_L), (E, QUOTE_RV, FRESH), (L, QUOTE_L, FRESH)):
        to[c, s], marks[c, s] = state, 0
    to[INSIDE], marks[INSIDE] = np.arange(STATES), 0
    return to, marks


NEXT, MARKS = splitter()


def state_maps(classes: np.ndarray) -> np.ndarray:
    """End state by start state of each chunk; ``classes`` has a row a byte place and a column a chunk."""
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (classes.shape[1], 1))
    table = NEXT.ravel()
    for row in classes:
        maps = table[row[:, None] * np.uint8(STATES) + maps]
    return maps


def scan(maps: np.ndarray) -> np.ndarray:
    """Row k: the composition of the maps 0 .. k, by doubling distances."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)  # first the earlier chunks, then these
        step *= 2
    return out


def piece_starts(classes: np.ndarray, chunk: int = CHUNK_BYTES) -> np.ndarray:
    """Whether a piece begins at each byte."""
    n = len(classes)
    rows = -(-(n + 1) // chunk)
    padded = np.full(rows * chunk, SPACE, dtype=np.uint8)  # white space after the end decides what is open
    padded[:n] = classes
    lanes = np.ascontiguousarray(padded.reshape(rows, chunk).T)
    state = np.zeros(rows, dtype=np.uint8)
    state[1:] = scan(state_maps(lanes))[:-1, FRESH]
    seen = np.empty_like(lanes)
    table, marks = NEXT.ravel(), MARKS.ravel()
    for place, row in enumerate(lanes):
        at = row * np.uint8(STATES) + state
        seen[place], state = marks[at], table[at]
    seen = seen.T.ravel()
    out = (seen & HERE).astype(bool)
    out[:-1] |= (seen[1:] & BEFORE).astype(bool)
    return out[:n]


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level file: printable Latin-1 itself, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Merges:
    """The merge rules over byte symbols; a symbol that ends a piece is another one."""

    def __init__(self, model: dict, byte_of: dict[str, int]):
        suffix = model["end_of_word_suffix"]
        vocabulary = model["vocab"]

        def spelled(token: str) -> tuple[bytes, bool]:
            last = token.endswith(suffix)
            return bytes(byte_of[c] for c in (token[:-len(suffix)] if last else token)), last

        #: (bytes, ends a piece) of the tokens that single bytes or merges make, to number
        self.number: dict[tuple[bytes, bool], int] = {}
        for b in byte_of.values():
            for last in (False, True):
                self.number[bytes([b]), last] = len(self.number)
        self.text = [k for k in self.number]
        self.parts: list[tuple[int, int] | None] = [None] * len(self.text)
        self.rank: dict[tuple[int, int], int] = {}
        self.made = [-1] * len(self.text)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            if left + right not in vocabulary:
                raise ValueError(f"a merge makes an unknown token: {pair}")
            a, b = self.number.get(spelled(left)), self.number.get(spelled(right))
            key = spelled(left + right)
            if a is None or b is None or key in self.number:
                raise ValueError(f"merges are not a tree: {pair}")
            self.number[key] = len(self.text)
            self.text.append(key)
            self.parts.append((a, b))
            self.rank[a, b] = rank
            self.made.append(rank)
        #: whether merging the token's own bytes gives the token (a rule of lower rank may prevent it)
        self.whole = [p is None for p in self.parts]
        for t, p in enumerate(self.parts):
            if p is not None:
                self.whole[t] = self.whole[p[0]] and self.whole[p[1]] and self._borders(*p, self.made[t])
        self.kept: dict[tuple[int, int], bool] = {}
        #: what a piece's suffix must be part of to matter later
        self.open = {text[:k] for text, _ in self.number for k in range(len(text))}
        self.longest = max(len(text) for text, _ in self.number)

    def _spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """(token, rank that makes it, rank that uses it up) along one border, from the token inwards."""
        out, until = [], 1 << 60
        while True:
            out.append((token, self.made[token], until))
            if self.parts[token] is None:
                return out
            until = self.made[token]
            token = self.parts[token][side]

    def _borders(self, a: int, b: int, before: int) -> bool:
        """No rule of a rank under ``before`` merges across the border while both tokens are being made."""
        right = self._spine(b, 0)
        for x, made_x, until_x in self._spine(a, 1):
            for y, made_y, until_y in right:
                rank = self.rank.get((x, y))
                # at equal ranks the place further left goes first: the left token's own merge wins, the right one's loses
                if rank is not None and rank < before and rank >= made_x and rank >= made_y and rank < until_x and rank <= until_y:
                    return False
        return True

    def keep(self, a: int, b: int) -> bool:
        """Whether merging the two tokens' bytes gives the two tokens."""
        out = self.kept.get((a, b))
        if out is None:
            if len(self.kept) > 2_000_000:
                self.kept.clear()
            out = self.kept[a, b] = self._borders(a, b, 1 << 60)
        return out


class Pieces:
    """count(piece): tokens of a piece, by arcs that are compiled when first taken."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.known: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.arcs: list[dict[int, tuple[int, int]]] = []
        self.last: list[dict[int, int]] = []
        self._state((b"", ((-1, 0),)))

    def _state(self, state: tuple) -> int:
        if (k := self.numbers.get(state)) is None:
            k = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.arcs.append({})
            self.last.append({})
        return k

    def _token(self, text: bytes, places, last: bool) -> tuple[int, int]:
        """The last token of the merge result up to the end of ``text``, and its count."""
        m = self.merges
        for k, (before, count) in enumerate(places):
            token = m.number.get((text[k:], last))
            if token is not None and m.whole[token] and (before < 0 or m.keep(before, token)):
                return token, count + 1
        raise ValueError("no token fits")

    def _arc(self, k: int, byte: int) -> tuple[int, int]:
        suffix, places = self.states[k]
        text = suffix + bytes([byte])
        places = [*places, self._token(text, places, False)]
        drop = max(0, len(text) - self.merges.longest)
        while text[drop:] not in self.merges.open:
            drop += 1
        places = places[drop:]
        sure = min(c for _, c in places)
        self.arcs[k][byte] = out = self._state((text[drop:], tuple((t, c - sure) for t, c in places))), sure
        return out

    def _final(self, k: int, byte: int) -> int:
        suffix, places = self.states[k]
        self.last[k][byte] = out = self._token(suffix + bytes([byte]), places, True)[1]
        return out

    def count(self, piece: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self.clear()
        k = total = 0
        arcs = self.arcs
        for byte in piece[:-1]:
            k, sure = arcs[k].get(byte) or self._arc(k, byte)
            total += sure
        return total + (self.last[k].get(piece[-1]) or self._final(k, piece[-1]))

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > MOST_PIECES:
            known.clear()
        out = []
        for p in pieces:
            n = known.get(p)
            if n is None:
                n = known[p] = self.count(p)
            out.append(n)
        return np.array(out, dtype=np.int64)


class Splitter:
    """Texts to pieces; the file's library serves normal forms and character classes only."""

    def __init__(self, text: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.spec = spec = json.loads(text)
        if (spec["model"]["type"], spec["model"].get("end_of_word_suffix")) != ("BPE", "</w>") or any(
                spec["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
            raise ValueError("a byte-level BPE with an end-of-word suffix is expected")
        if [p.get("pattern", {}).get("Regex") for p in spec["pre_tokenizer"]["pretokenizers"]] != [SPLIT, None]:
            raise ValueError("another split rule is expected")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that match as they stand are expected")
        self.library = Tokenizer.from_str(text)
        self.normal = self.library.normalizer.normalize_str
        self.split = pre_tokenizers.Split(Regex(SPLIT), behavior="removed", invert=True).pre_tokenize_str
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.classes = np.full(0x110000, 255, dtype=np.uint8)  # 255: not asked yet
        for i in range(128):
            self._ask(i)

    def _ask(self, point: int) -> None:
        ch = chr(point)
        if self.normal(ch) == " " or not self.split(ch):
            kind = SPACE
        elif len(self.split("a" + ch)) == 1:
            kind = LETTER
        else:
            kind = DIGIT if len(self.split(ch + ch)) == 2 else OTHER
        self.classes[point] = {"'": MARK, "e": E, "l": L, "r": R_V, "v": R_V, "d": ENDS, "m": ENDS, "s": ENDS, "t": ENDS}.get(chr(point), kind)

    def classes_of(self, b: np.ndarray) -> np.ndarray:
        """A class a byte of valid UTF-8; a character's class stands at its first byte."""
        out = self.classes[b]
        far = np.flatnonzero(b >= 0x80)
        if len(far):
            out[far] = INSIDE
            lead = far[b[far] >= 0xC0]
            first = b[lead].astype(np.int64)
            size = 2 + (first >= 0xE0) + (first >= 0xF0)
            point = first & (0x7F >> size)
            for k in (1, 2, 3):
                more = size > k
                point[more] = point[more] << 6 | b[lead[more] + k] & 0x3F
            for p in np.unique(point[self.classes[point] == 255]).tolist():
                self._ask(p)
            out[lead] = kind = self.classes[point]
            for k in (1, 2, 3):  # all bytes of a wide white space
                out[lead[(kind == SPACE) & (size > k)] + k] = SPACE
        return out

    def plain(self, text: str) -> bytes:
        """Normalised text; where every character is below U+0300 that is lower-casing alone."""
        low = text.lower() if text.isascii() or not LATE.search(text) else self.normal(text)
        return low.encode()

    def pieces(self, plain: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
        """All pieces of the normalised texts one after another, and how many there are up to the end of each text."""
        b = np.frombuffer(b" ".join(plain), dtype=np.uint8)
        classes = self.classes_of(b)
        starts = piece_starts(classes)
        # white space goes: the pieces lie one after another, each as long as the way to the next start
        solid = np.flatnonzero(classes != SPACE)
        first = np.flatnonzero(starts[solid])
        ends = np.r_[first, len(solid)].astype(np.int32)
        found = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(b[solid].tobytes())])
        return found, np.searchsorted(solid[first], np.cumsum([len(p) + 1 for p in plain]))


class Counter(Splitter):
    """The compiled tokenizer."""

    def __init__(self, text: str):
        super().__init__(text)
        self.counter = Pieces(Merges(self.spec["model"], byte_names()))

    def parts(self, texts: list[str | None]):
        """(text number, normalised bytes, special tokens in it) in parts of bounded size that end at white space."""
        for k, t in enumerate(texts):
            n = 0
            if t and self.special and "<" in t:
                t, n = self.special.subn(" ", t)
            while t and len(t) > PART_BYTES and (m := re.compile(r"[ \t-\r]").search(t, PART_BYTES)):
                yield k, self.plain(t[:m.start()]), n
                t, n = t[m.end():], 0
            yield k, self.plain(t or ""), n

    def count(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        wait, size = [], 0
        for part in self.parts(texts):
            out[part[0]] += part[2]
            wait.append(part)
            size += len(part[1]) + 1
            if size >= PART_BYTES:
                self._count(wait, out)
                wait, size = [], 0
        if wait:
            self._count(wait, out)
        return out

    def _count(self, parts: list, out: np.ndarray) -> None:
        found, upto = self.pieces([p[1] for p in parts])
        coded = found.dictionary_encode()
        n = self.counter.counts(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        total = np.r_[0, np.cumsum(n)]
        np.add.at(out, [p[0] for p in parts], np.diff(total[upto], prepend=0))


_counters: dict[int, Counter] = {}


def compiled(text: str) -> Counter:
    """One per worker process and file."""
    key = hash(text)
    if key not in _counters:
        _counters[key] = Counter(text)
    return _counters[key]


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    with open(vocabulary_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        counter = compiled(held.value)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counter.count(part.column(2).to_pylist()))], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return (slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
