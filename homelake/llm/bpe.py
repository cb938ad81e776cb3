"""Byte-pair encoding of texts through a minimal acyclic transducer of frequent words, and decoding.

1. Texts are cut into words by the tokenizer's pattern and the words counted over the whole corpus; the most frequent of at most
   ``WORD_BYTES`` bytes, up to ``LEXICON_WORDS``, are the lexicon (a documented bound: it sets the speed, never the ids).
2. The lexicon is compiled on the driver: its words, sorted, become the smallest acyclic automaton that accepts them, in which equal suffixes are
   shared.  An arc carries the number of lexicon words that sort before what follows it, so the sum along a word's path is that word's
   number, and the number leads to its ids.  The arrays lie in one file in the shared folder, which Spark hands to every executor and workers map
   into memory.
3. Encoding walks all different words of a few texts through the automaton at once.  A word that is not in it is merged exactly: always the pair of
   lowest rank, the leftmost of these.  A worker keeps the ids of up to about ``HELD_WORDS`` words, so it looks a word up once for many texts.

Merge ranks and ids are read from a ``tokenizers`` file on the driver and broadcast (a few MB whatever the corpus).  Texts stay where they lie; only
word counts are shuffled.  Added tokens in a text get their own id, as the library does by default.

Defined results: a null or empty text has no ids and decodes to an empty text; bytes that are no UTF-8 decode to replacement characters; repeated rows
are encoded each; an empty table has no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, islice, pairwise
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.session import cut_lineage, shared_folder

LEXICON_WORDS = 1 << 16
WORD_BYTES = 32
CHUNK_CHARS = 1 << 20
# A worker keeps counts and ids of the words it met until they are so many, or come from so many characters.
HELD_WORDS = 1 << 18
HELD_CHARS = 1 << 24
# Tokens decoded at once, in whole texts.
CHUNK_TOKENS = 1 << 18
# Longer words are merged by a heap.
LONG_WORD = 64
_ID_BITS = 24
_ID = (1 << _ID_BITS) - 1
_NONE = 1 << 62
# Fixed value: the pattern of byte-level tokenizers, which is 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+, as it reads for
# ASCII, for Python's faster module; of other texts it gets the characters that stand for theirs.
ASCII_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in a vocabulary file: itself where it is printable, else one beyond the first 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(rest)}


class Tokenizer:
    """What a byte-level ``tokenizers`` file says: ids of single bytes, merges of pairs of ids, the bytes of each id, added tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, split = content["model"], content["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or content["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE: {path}")
        if model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError(f"options of this file are not supported: {path}")
        letters, vocabulary = byte_letters(), model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.single = [vocabulary[letter] for letter, _ in sorted(letters.items(), key=lambda item: item[1])]
        # A merge is its rank (from 1) above the id it gives, so the least one is the one to do.
        self.merges = {(vocabulary[a], vocabulary[b]): (rank + 1) << _ID_BITS | vocabulary[a + b] for rank, (a, b) in enumerate(pairs)}
        self.pieces = {at: bytes(letters[letter] for letter in token) for token, at in vocabulary.items()}
        self.added = {token["content"]: token["id"] for token in content["added_tokens"]}
        if any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in content["added_tokens"]):
            raise ValueError(f"added tokens of this file are not supported: {path}")
        self.pieces.update((at, token.encode()) for token, at in self.added.items())

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word: while any two neighbours merge, those of lowest rank do, the leftmost first."""
        ids: list[int] = [self.single[b] for b in word]
        if len(ids) > LONG_WORD:
            return self._merged_long(ids)
        steps = [self.merges.get(pair, _NONE) for pair in zip(ids, ids[1:])]
        while steps and (step := min(steps)) != _NONE:
            at = steps.index(step)
            ids[at : at + 2] = [step & _ID]
            del steps[at]
            if at:
                steps[at - 1] = self.merges.get((ids[at - 1], ids[at]), _NONE)
            if at < len(steps):
                steps[at] = self.merges.get((ids[at], ids[at + 1]), _NONE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same in n log n steps: neighbours wait in a heap."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        waiting = [(self.merges[pair], at) for at, pair in enumerate(zip(ids, ids[1:])) if pair in self.merges]
        heapq.heapify(waiting)
        while waiting:
            step, at = heapq.heappop(waiting)
            right = after[at]
            if ids[at] < 0 or right >= len(ids) or self.merges.get((ids[at], ids[right])) != step:
                continue  # one of the two has changed since
            ids[at], ids[right], after[at] = step & _ID, -1, after[right]
            if after[at] < len(ids):
                before[after[at]] = at
                if found := self.merges.get((ids[at], ids[after[at]])):
                    heapq.heappush(waiting, (found, at))
            if before[at] >= 0 and (found := self.merges.get((ids[before[at]], ids[at]))):
                heapq.heappush(waiting, (found, before[at]))
        return [i for i in ids if i >= 0]


_UNKNOWN = 255


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    """Of every code point an ASCII character that the pattern treats alike (ASCII stands for itself), ``_UNKNOWN`` where Python's Unicode tables
    do not know it: of those, pattern libraries of different ages disagree."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    signs = np.full(len(every), ord("!"), dtype=np.uint8)
    for kind, sign in ((r"\p{L}+", "A"), (r"\p{N}+", "0"), (r"\s+", "\t")):
        for run in regex.finditer(kind, every):
            signs[run.start() : run.end()] = ord(sign)
    signs[np.array([unicodedata.category(c) == "Cn" for c in every])] = _UNKNOWN
    signs[:128] = np.arange(128)
    return signs


class Splitter:
    """Cuts texts into words and added tokens (as their ids)."""

    def __init__(self, added: dict[str, int]) -> None:
        self.ascii_words = re.compile(ASCII_PATTERN).findall
        self.added = added
        # Of two added tokens at one place the longer holds.
        longest = sorted(added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words(text)
        signs = _signs()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        if signs.max() != _UNKNOWN:
            # Every character is in a word, so the words' lengths tell where they lie.
            return [text[a:b] for a, b in pairwise(accumulate(map(len, self.ascii_words(signs.tobytes().decode("ascii"))), initial=0))]
        from tokenizers.pre_tokenizers import ByteLevel  # what its tables say of such a code point holds

        return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]

    def __call__(self, text: str) -> list[str | int]:
        if not self.marks or not any(mark in text for mark in self.added):
            return self._plain(text)
        out: list[str | int] = []
        for at, part in enumerate(self.marks.split(text)):
            out += [self.added[part]] if at % 2 else self._plain(part)
        return out


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``CHUNK_CHARS`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + CHUNK_CHARS, side="right")))
        yield batch.slice(start, end - start)
        start = end


def frequent_words(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", words: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of all texts, at most ``words``, sorted; words of like frequency come all or none."""
    added = tokenizer.added

    def counted(found: Counter) -> pa.RecordBatch:
        for mark in added.values():
            found.pop(mark, None)
        words = pa.array(found.keys(), pa.string()).cast(pa.binary())
        batch = pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64())], names=["word", "n"])
        return batch.filter(pc.less_equal(pc.binary_length(words), WORD_BYTES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found, chars = Splitter(added), Counter(), 0
        for batch in batches:
            for chunk in _chunks(batch, 0):
                for content in chunk.column(0).to_pylist():
                    if content:
                        found.update(split(content))
                        chars += len(content)
                if len(found) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield counted(found)
                    found, chars = Counter(), 0
        yield counted(found)

    counts = cut_lineage(docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    # The least frequency that no more than ``words`` words reach, to a tenth of a binary order.
    order = F.floor(F.log2("n") * 10)
    reached, least = 0, None
    for row in counts.groupBy(order.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        reached += row["words"]
        if reached > words:
            break
        least = row["level"]
    return sorted(bytes(row["word"]) for row in counts.where(order >= least).select("word").collect()) if least is not None else []


def minimal_automaton(words: list[bytes]) -> tuple[list[tuple[bool, tuple]], int]:
    """States (whether a word ends, arcs as (byte, state)) of the smallest acyclic automaton of sorted words, and the first state."""
    states: dict[tuple[bool, tuple], int] = {}
    trail: list[list] = [[False, []]]  # open states along the last word: whether a word ends, arcs
    last = b""

    def close(depth: int) -> None:
        while len(trail) > depth + 1:
            ends, arcs = trail.pop()
            trail[-1][1].append((last[len(trail) - 1], states.setdefault((ends, tuple(arcs)), len(states))))

    for word in words:
        shared = next((at for at, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(shared)
        trail.extend([False, []] for _ in word[shared:])
        trail[-1][0], last = True, word
    close(0)
    first = states.setdefault((trail[0][0], tuple(trail[0][1])), len(states))
    return list(states), first


def compiled(words: list[bytes], tokenizer: Tokenizer) -> np.ndarray:
    """The transducer as one array of 32-bit integers: five sizes, arcs (key, target, output), whether states end a word, ids by word number."""
    states, first = minimal_automaton(words)
    if len(states) >= 1 << 23:
        raise ValueError("too many states for 32-bit arcs")
    below = [0] * len(states)  # how many words are accepted from a state on; what a state leads to comes before it
    keys, targets, outputs = [], [], []
    for at, (ends, arcs) in enumerate(states):
        passed = int(ends)
        for label, target in arcs:
            keys.append(at << 8 | label)
            targets.append(target)
            outputs.append(passed)
            passed += below[target]
        below[at] = passed
    ids = [tokenizer.merged(word) for word in words]
    ends = np.cumsum([0, *map(len, ids)])
    sizes = [len(keys), len(states), len(words), int(ends[-1]), first]
    return np.concatenate([np.asarray(part, dtype=np.int64) for part in (
        sizes, keys, targets, outputs, [int(ends_) for ends_, _ in states], ends, [i for own in ids for i in own])]).astype("<i4")


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of runs of given begins and sizes, one run after another."""
    ends = np.cumsum(size, dtype=np.int64)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Lexicon:
    """A compiled transducer, mapped from a file or held in an array."""

    def __init__(self, source: str | np.ndarray) -> None:
        content = np.memmap(source, dtype="<i4", mode="r").view(np.ndarray) if isinstance(source, str) else source
        arcs, states, words, ids, self.first = (int(n) for n in content[:5])
        edges = np.cumsum([5, arcs, arcs, arcs, states, words + 1, ids])
        self.keys, self.targets, self.outputs, self.final, self.starts, self.ids = (content[a:b] for a, b in zip(edges, edges[1:]))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for words that are not in the lexicon; all words walk on together, a byte a step."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        content, begin = np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(size) - size
        # Of the arcs' own type, or every search would first copy them.
        state, number = np.full(len(words), self.first, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        if not len(self.keys):
            return np.full(len(words), -1)
        state[size > WORD_BYTES] = -1
        walking, step = np.flatnonzero((state >= 0) & (size > 0)), 0
        while len(walking):
            key = state[walking] << 8 | content[begin[walking] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            met = self.keys[arc] == key
            state[walking] = np.where(met, self.targets[arc], -1)
            number[walking] += np.where(met, self.outputs[arc], 0)
            step += 1
            walking = walking[met & (size[walking] > step)]
        ends = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(ends, number, -1)


class Merger:
    """Merges many words at once: a row per word, one merge per row and step, as :meth:`Tokenizer.merged` does for one."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer
        keys = np.array([a << _ID_BITS | b for a, b in tokenizer.merges], dtype=np.int64)
        steps = np.fromiter(tokenizer.merges.values(), dtype=np.int64, count=len(keys))
        order = np.argsort(keys)
        # Ranks rise from 1 in the order of the merges; the last entry stands for no merge.
        self.keys, self.ranks = keys[order], (steps[order] >> _ID_BITS).astype(np.int32)
        self.none = int(self.ranks.max(initial=0)) + 1
        self.merged = np.zeros(self.none + 1, dtype=np.int32)
        self.merged[steps >> _ID_BITS] = steps & _ID
        self.single = np.array(tokenizer.single, dtype=np.int32)
        self.bytes = self._of(np.repeat(self.single, 256), np.tile(self.single, 256))

    def _of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``none`` where there is none or one of the two is past the end (-1)."""
        if not len(self.keys):
            return np.full(left.shape, self.none, dtype=np.int32)
        key = left.astype(np.int64) << _ID_BITS | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], np.int32(self.none))

    def __call__(self, words: list[bytes]) -> list[np.ndarray]:
        ids, size = self.joined(words)
        return np.split(ids, np.cumsum(size)[:-1]) if words else []

    def joined(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, how many each has)."""
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, their sizes, their ids
        for row in np.flatnonzero(length > LONG_WORD):
            own = np.array(self.tokenizer.merged(words[row]), dtype=np.int32)
            done.append((np.array([row]), np.array([len(own)]), own))
        low, width = 0, 8
        while low < LONG_WORD:
            rows = np.flatnonzero((length > low) & (length <= width))
            if len(rows):
                self._band([words[row] for row in rows], rows, width, done)
            low, width = width, width * 2
        size = np.zeros(len(words), dtype=np.int64)
        if not done:
            return np.array([], dtype=np.int32), size
        rows, sizes, ids = (np.concatenate(parts) for parts in zip(*done))
        size[rows] = sizes
        joined = np.empty(len(ids), dtype=np.int32)
        joined[_runs((np.cumsum(size) - size)[rows], sizes)] = ids
        return joined, size

    def _band(self, words: list[bytes], rows: np.ndarray, width: int, done: list) -> None:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        places = np.arange(width + 1)
        inside, content = places < size[:, None], np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = np.full((len(words), width + 1), -1, dtype=np.int32)
        ids[inside] = self.single[content]
        # Pairs of bytes are looked up in a table; a word's last byte has no pair.
        steps = np.full((len(words), width), self.none, dtype=np.int32)
        paired = inside[:, 1:]
        begins = np.ones(len(content), dtype=bool)
        begins[np.cumsum(size) - 1] = False
        first = np.flatnonzero(begins)
        steps[paired] = self.bytes[content[first].astype(np.int64) << 8 | content[first + 1]]
        while len(rows):
            at = steps.argmin(axis=1)
            step = steps[np.arange(len(rows)), at]
            live = step != self.none
            if not live.all():
                ended = ~live
                done.append((rows[ended], size[ended], ids[ended][places < size[ended][:, None]]))
                rows, ids, steps, size, at, step = (part[live] for part in (rows, ids, steps, size, at, step))
            every = np.arange(len(rows))
            # What stands right of a merged pair moves up by one.
            moved = np.minimum(places + (places > at[:, None]), width)
            ids = np.take_along_axis(ids, moved, axis=1)
            steps = np.take_along_axis(steps, np.minimum(moved[:, :-1], width - 1), axis=1)
            ids[every, at], size = self.merged[step], size - 1
            steps[every, at] = self._of(ids[every, at], ids[every, at + 1])
            left = np.flatnonzero(at > 0)
            steps[left, at[left] - 1] = self._of(ids[left, at[left] - 1], ids[left, at[left]])


class _Numbered(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str | int) -> int:
        number = self[word] = len(self)
        return number


class Encoder:
    def __init__(self, lexicon: Lexicon, tokenizer: Tokenizer) -> None:
        self.lexicon, self.merger, self.split = lexicon, Merger(tokenizer), Splitter(tokenizer.added)
        self._forget()

    def _forget(self) -> None:
        self.index, self.chars = _Numbered(), 0
        self.pool, self.size = np.array([], dtype=np.int32), np.array([], dtype=np.int64)  # ids of the words by number, how many each has

    def _learn(self) -> None:
        """Add the ids of the words that were numbered since."""
        new = list(islice(self.index, len(self.size), None))
        marks = [(at, word) for at, word in enumerate(new) if isinstance(word, int)] if self.split.added else []
        for at, _ in marks:
            new[at] = ""
        words = [word.encode("utf-8", "surrogatepass") for word in new]
        numbers, lexicon = self.lexicon.numbers(words), self.lexicon
        known, unseen = np.flatnonzero(numbers >= 0), np.flatnonzero(numbers < 0)
        size, begin = np.zeros(len(new), dtype=np.int64), lexicon.starts[numbers[known]].astype(np.int64)
        size[known] = lexicon.starts[numbers[known] + 1] - begin
        merged, size[unseen] = self.merger.joined([words[at] for at in unseen])
        for at, _ in marks:
            size[at] = 1
        place = np.cumsum(size) - size
        own = np.empty(int(size.sum()), dtype=np.int32)
        own[_runs(place[known], size[known])] = lexicon.ids[_runs(begin, size[known])]
        for at, mark in marks:
            own[place[at]] = mark
        if marks:
            unseen = np.setdiff1d(unseen, [at for at, _ in marks])
        own[_runs(place[unseen], size[unseen])] = merged
        self.pool, self.size = np.concatenate([self.pool, own]), np.concatenate([self.size, size])
        self.chars += sum(map(len, words))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's begin and the last one's end)."""
        if len(self.index) >= HELD_WORDS or self.chars >= HELD_CHARS:
            self._forget()
        number, parts = self.index.__getitem__, []
        for text in texts:
            words = self.split(text) if text else []
            parts.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)))
        if len(self.index) > len(self.size):
            self._learn()
        place = np.concatenate([np.array([], dtype=np.int64), *parts])
        length = self.size[place]
        upto = np.cumsum([0, *map(len, parts)])
        starts = np.concatenate([[0], np.cumsum(length)])[upto].astype(np.int32)
        return self.pool[_runs((np.cumsum(self.size) - self.size)[place], length)], starts


class Pieces:
    """Bytes of many ids at once."""

    def __init__(self, pieces: dict[int, bytes]) -> None:
        ids, own = list(pieces), list(pieces.values())
        size = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
        self.begin, self.size = np.zeros(max(ids, default=-1) + 1, dtype=np.int64), np.full(max(ids, default=-1) + 1, -1, dtype=np.int64)
        self.begin[ids], self.size[ids] = np.cumsum(size) - size, size
        self.content = np.frombuffer(b"".join(own), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after another, how many each has)."""
        known = (ids >= 0) & (ids < len(self.size))
        if not known.all() or (len(ids) and self.size[ids].min() < 0):
            raise KeyError("an id that is not in the vocabulary")
        size = self.size[ids]
        return self.content[_runs(self.begin[ids], size)], size

    def texts(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """Texts of runs of ids that begin at ``starts`` (and end at its last entry)."""
        content, size = self(ids)
        ends = np.concatenate([[0], np.cumsum(size)])[starts]
        whole = content.tobytes()
        try:
            whole.decode("utf-8")
            # A text that began inside a character would not be UTF-8 by itself.
            valid = not ((content[ends[:-1][ends[:-1] < len(content)]] & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            valid = False
        if valid:
            return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(whole))
        return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in pairwise(ends.tolist())], pa.string())


def _shared_lexicon(spark: SparkSession, content: np.ndarray) -> str:
    """Write the transducer into the shared folder and let Spark bring it to every executor; its name there."""
    name = f"lexicon-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{name}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(path)
    out.write(bytearray(content.tobytes()))
    out.close()
    spark.sparkContext.addFile(system.makeQualified(path).toString())
    return name


def encode_texts(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", output: str = "ids", words: list[bytes] | None = None) -> DataFrame:
    """``docs`` without the text, with its ids (array of int); ``words`` is a sorted lexicon, by default the frequent words of these texts."""
    spark = docs.sparkSession
    name = _shared_lexicon(spark, compiled(frequent_words(docs, tokenizer, text) if words is None else words, tokenizer))
    shared = spark.sparkContext.broadcast(tokenizer)
    kept = [column for column in docs.columns if column not in (text, output)]
    source = docs.select(F.col(text).alias(output), *kept)
    schema = docs.select(*kept).withColumn(output, F.array().cast("array<int>")).select(output, *kept).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Lexicon(SparkFiles.get(name)), shared.value)
        for batch in batches:
            for chunk in _chunks(batch, 0):
                ids, starts = encoder(chunk.column(0).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([lists, *chunk.columns[1:]], names=chunk.schema.names)

    return source.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, tokenizer: Tokenizer, ids: str = "ids", output: str = "decoded", packed: str | None = None) -> DataFrame:
    """``encoded`` without the ids, with the text they stand for and, if ``packed`` names a column, the ids as little-endian 32-bit integers."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer.pieces)
    kept = [column for column in encoded.columns if column not in (ids, output, packed)]
    source = encoded.select(F.col(ids).alias("__ids"), *kept)
    added = {output: F.lit("").cast("string")} | ({packed: F.lit(None).cast("binary")} if packed else {})
    schema = encoded.select(*kept).withColumns(added).select(*added, *kept).schema
    for field in schema.fields[: len(added)]:
        field.nullable = True

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            lists = batch.column(0)
            values, starts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
            row = 0
            while row < len(batch):
                # Whole texts of about ``CHUNK_TOKENS`` ids, one at least.
                end = max(row + 1, int(np.searchsorted(starts, starts[row] + CHUNK_TOKENS, side="right")) - 1)
                ids, own = values[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
                columns = [pieces.texts(ids, own)]
                if packed:
                    columns.append(pa.Array.from_buffers(
                        pa.binary(), len(own) - 1, [None, pa.py_buffer((own * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4").tobytes())]))
                yield pa.RecordBatch.from_arrays(
                    [*columns, *batch.slice(row, end - row).columns[1:]], names=[field.name for field in schema])
                row = end

    return source.mapInArrow(decode, schema)


def op13_bpe(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    if tokenizer_file is None:
        import public_tokenizers

        tokenizer_file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer(tokenizer_file)
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)
    decoded = decode_ids(encoded.withColumn("n_tokens", F.size("ids").cast("long")), tokenizer, packed="packed")
    return decoded.select(
        "doc_id", "n_tokens", F.sha2(F.col("packed"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
