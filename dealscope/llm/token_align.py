"""Alignment of two tokenizers' tokens on the same texts, by interval coalescing.

A text is cut into units before each space that follows something else: neither
tokenizer has a token across such a place, so a unit's tokens are the same in any
text (``Pair.splits``; where a tokenizer doesn't allow that, a text is one unit).
A chunk of documents encodes its distinct units once, all tokens of both sides are
sorted by start, and the running maximum of their ends tells where both sides end
together: there groups break. Inside a group every token of A is linked to every
token of B.

Counts of linked id pairs over the corpus come from the distinct pairs of each
chunk and go back to the chunks that hold them, so neither the pairs of every
document nor the texts are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.tables import kept

#: Characters of text whose documents share one table of units and pairs; a longer text is a chunk alone.
CHUNK_CHARS = 1 << 23
#: Characters of units in one call of the tokenizers, and units of documents that are looked up at once.
CALL_CHARS, LOOKUP_UNITS = 1 << 18, 1 << 20
#: Where a unit may start. Python's white space holds all that a tokenizer's pattern calls so.
_CUT, _WIDE = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")
#: Characters that every version of Unicode puts into the same classes.
_PLAIN = re.compile("[\t\n\r -~\u00a1-\u024f]*")
SPACE = "▁"
#: Fixed value: how byte-level BPE cuts a text before merging.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Links(NamedTuple):
    """Groups and linked pairs of units: ``pair`` is A's id times 2^32 plus B's, ``times`` how often it occurs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    text: list[str]
    unit: np.ndarray
    pair: np.ndarray
    times: np.ndarray


class Pair:
    """The two tokenizers, loaded once a worker: a byte-level BPE in JSON and a piece model with byte fallback."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(SPACE)
        spec = json.loads(self.a.to_str())
        cutter = spec.get("pre_tokenizer") or {}
        plain_a = (spec.get("normalizer") is None and cutter.get("type") == "ByteLevel"
                   and cutter.get("use_regex", True) and not cutter.get("add_prefix_space"))
        # Whether no token of either side can reach over a place where _CUT cuts.
        self.splits = (plain_a and self.b.normalize("x  y ") == f"{SPACE}x{SPACE}{SPACE}y{SPACE}"
                       and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces))
        self.fast = _by_ranks(spec["model"], self.a_bytes, letters) if plain_a else None

    def keys(self, text: str) -> list[str]:
        """The units of a space and the text, each without the space that it starts with."""
        if not self.splits:
            return [text]
        if text[0] != " " and not _WIDE.search(text):
            return text.split(" ")
        return [unit[1:] for unit in _CUT.split(" " + text)]

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of a text that starts with a space; the piece model adds that space itself."""
        if self.fast is not None and _PLAIN.fullmatch(text):
            a = self.fast.encode_ordinary(text)
        else:
            a = self.a.encode(text, add_special_tokens=False).ids
        return np.array(a, np.int64), np.array(self.b.encode(text[1:]) if len(text) > 1 else [self.space], np.int64)

    def _slices(self, units: list[str]) -> Iterator[np.ndarray]:
        """Places of units for one call each. Spaces alone would run into the next unit, so they are by themselves."""
        plain, other = [], []
        for i, unit in enumerate(units):
            if unit.isspace():
                yield np.array([i])
            else:
                (plain if _PLAIN.fullmatch(unit) else other).append(i)
        for places in (plain, other):
            total = np.cumsum([len(units[i]) for i in places])
            cuts = np.searchsorted(total, np.arange(CALL_CHARS, int(total[-1]) if len(total) else 0, CALL_CHARS))
            yield from (part for part in np.split(np.array(places, np.int64), np.unique(cuts)) if len(part))

    def _encoded(self, places: np.ndarray, units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Places, where their units end in bytes, and the ids of both sides; halved until the bytes come back and
        each unit's end is a token's end. Units of which that never holds are left out."""
        own = [units[i] for i in places]
        text = "".join(own)
        a, b = self._ids(text)
        joined = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) == joined and b"".join(
                map(self.b_bytes.__getitem__, b.tolist())) == joined:
            ends = np.cumsum([len(u.encode()) for u in own])
            if all(np.isin(ends, np.cumsum(size[ids])).all() for size, ids in ((self.a_size, a), (self.b_size, b))):
                yield places, ends, a, b
                return
        if len(places) > 1:
            for part in np.split(places, [len(places) // 2]):
                yield from self._encoded(part, units)

    def links(self, keys: list[str]) -> tuple[Links, np.ndarray]:
        """Groups and links of the units, and which of them could be aligned."""
        units = [" " + key for key in keys]
        n_a, n_b, n_groups = np.zeros((3, len(units)), np.int64)
        text, good, found = [""] * len(units), np.zeros(len(units), bool), []
        for wanted in self._slices(units):
            for places, ends, a, b in self._encoded(wanted, units):
                part = coalesced(a, b, self.a_size[a], self.b_size[b], ends)
                good[places] = True
                n_a[places], n_b[places], n_groups[places] = part.n_a, part.n_b, part.n_groups
                for i, groups in zip(places.tolist(), part.text):
                    text[i] = groups
                found.append((places[part.unit], part.pair, part.times))
        unit, pair, times = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(3))
        order = np.argsort(unit, kind="stable")
        return Links(n_a, n_b, n_groups, text, unit[order], pair[order], times[order]), good


def _by_ranks(model: dict, table: list[bytes], letters: dict[str, int]):
    """A faster encoder of the same vocabulary, if each merge makes the next id: then ranks and merges agree."""
    import tiktoken

    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocabulary, size = model["vocab"], len(letters)
    if [vocabulary.get("".join(m)) for m in merges] != list(range(size, size + len(merges))):
        return None
    ranks = {table[i]: i for i in range(size + len(merges))}
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


def coalesced(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, unit_ends: np.ndarray) -> Links:
    """Groups of consecutive units, from the ids of both sides, their lengths in bytes and where the units end."""
    ids = np.concatenate([a, b])
    of_a = np.arange(len(ids)) < len(a)
    end = np.concatenate([np.cumsum(a_size), np.cumsum(b_size)])
    start = end - np.concatenate([a_size, b_size])
    order = np.lexsort((~of_a, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.cumsum(breaks) - 1
    first = np.flatnonzero(breaks)
    of_unit = np.searchsorted(unit_ends, start[order][first], "right")
    ids, of_a = ids[order], of_a[order]
    # A's tokens of a group before B's.
    order = np.lexsort((~of_a, group))
    ids, of_a, group = ids[order], of_a[order], group[order]
    count = len(unit_ends)
    # Within a group equal ids count together: distinct ids are paired, not places.
    left, right = _counted(group[of_a], ids[of_a]), _counted(group[~of_a], ids[~of_a])
    a_from = np.searchsorted(left[0], np.arange(len(first) + 1))
    width = np.diff(a_from)[right[0]]
    at_b = np.repeat(np.arange(len(width)), width)
    at_a = np.repeat(a_from[right[0]], width) + np.arange(len(at_b)) - np.repeat(np.cumsum(width) - width, width)
    pair = (left[1][at_a] << 32) | right[1][at_b]
    # A pair may come in several groups of a unit: one row each unit.
    summed = _summed(of_unit[right[0][at_b]], pair, left[2][at_a] * right[2][at_b])
    n_a, n_b = (np.bincount(of_unit[group[side]], minlength=count) for side in (of_a, ~of_a))
    return Links(n_a, n_b, np.bincount(of_unit, minlength=count), _texts(ids, of_a, group, n_a + n_b), *summed)


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _summed(group, ids, np.ones(len(ids), np.int64))


def _summed(major: np.ndarray, minor: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (major, minor) in order, and the sums of ``times``."""
    order = np.lexsort((minor, major))
    major, minor, times = major[order], minor[order], times[order]
    new = np.ones(len(order), bool)
    new[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
    first = np.flatnonzero(new)
    return major[first], minor[first], np.add.reduceat(times, first) if len(first) else times


def _texts(ids: np.ndarray, of_a: np.ndarray, group: np.ndarray, tokens: np.ndarray) -> list[str]:
    """Of each unit, a run of so many tokens, its groups as ``a1,a2|b1;a3|b2``."""
    last = np.append(group[1:] != group[:-1], True)
    turn = np.append(of_a[1:] != of_a[:-1], True)
    marks = np.where(last, 2, turn.astype(np.int64)).tolist()
    parts = [f"{i}{',|;'[m]}" for i, m in zip(ids.tolist(), marks)]
    ends = np.cumsum(tokens).tolist()
    return ["".join(parts[s:e])[:-1] for s, e in zip([0, *ends], ends)]


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=2)
def _loaded(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


class _Codes(dict):
    """Numbers units as they come."""

    def __missing__(self, unit: str) -> int:
        self[unit] = code = len(self)
        return code


class _Chunk:
    """Documents of about CHUNK_CHARS and the units they hold."""

    def __init__(self, pair: Pair):
        self.pair, self.codes, self.docs, self.size = pair, _Codes(), [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        keys = self.pair.keys(text) if text else []
        self.docs.append([doc_id, np.fromiter(map(self.codes.__getitem__, keys), np.int32, len(keys))])
        self.size += len(text or "") + 64

    def links(self) -> Links:
        """Links of all units; the units themselves go. A document with a unit that can't be aligned is tried as one unit, and else has none."""
        names = list(self.codes)
        links, good = self.pair.links(names)
        if good.all():
            self.codes.clear()
            return links
        bad = [d for d in self.docs if not good[d[1]].all()]
        for doc in bad:
            doc[1] = np.array([self.codes[" ".join(map(names.__getitem__, doc[1].tolist()))]], np.int32)
        more = list(self.codes)[len(names):]
        links, good = self.pair.links(names + more)
        for doc in bad:
            if not good[doc[1]].all():
                doc[1] = doc[1][:0]
        return links


def _batch_chunks(batches: Iterator[pa.RecordBatch], pair: Pair) -> Iterator[_Chunk]:
    chunk = _Chunk(pair)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if chunk.docs and chunk.size + len(text or "") > CHUNK_CHARS:
                full, chunk = chunk, _Chunk(pair)
                yield full
                del full
            chunk.add(doc_id, text)
    if chunk.docs:
        yield chunk


def _groups_text(codes: np.ndarray, text: list[str]) -> str:
    return ";".join(map(text.__getitem__, codes.tolist()))


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, groups`` of each row: its groups of tokens as ``a1,a2|b1;a3|b2,b3``, empty where there are none."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _batch_chunks(batches, _loaded(a_path, b_path)):
            links = chunk.links()
            for doc_id, codes in chunk.docs:
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array(
                    [_groups_text(codes, links.text)], pa.string())], ["doc_id", "groups"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, groups string")


#: Of a chunk: its documents, its distinct pairs with how many documents hold each, and as packed numbers the documents'
#: figures and units, and per unit its pairs and how often it has them.
_CHUNKS = ("chunk long, doc_id array<long>, digest array<string>, pair array<long>, pair_docs array<int>, "
           "size long, packed binary")


def _packed(arrays: list[np.ndarray]) -> tuple[int, bytes]:
    """Arrays of numbers in few bytes: the first bytes of all numbers, then the second ones, compressed."""
    raw = np.array([len(a) for a in arrays], np.int64).tobytes()
    raw += b"".join(np.ascontiguousarray(a, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    return len(raw), pa.compress(raw, "zstd", asbytes=True)


def _unpacked(size: int, packed: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), np.uint8)
    lengths, at, out = raw[:8 * count].view(np.int64), 8 * count, []
    for n in lengths.tolist():
        out.append(np.ascontiguousarray(raw[at:at + 8 * n].reshape(8, n).T).view(np.int64).ravel())
        at += 8 * n
    return out


def _chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in enumerate(_batch_chunks(batches, _loaded(a_path, b_path))):
            links = chunk.links()
            pairs, place = np.unique(links.pair, return_inverse=True)
            n_links = np.zeros(len(links.n_a), np.int64)
            np.add.at(n_links, links.unit, links.times)
            codes = [c for _, c in chunk.docs]
            figures = [np.array([int(f[c].sum()) for c in codes], np.int64)
                       for f in (links.n_a, links.n_b, links.n_groups, n_links)]
            digest = [hashlib.sha256(_groups_text(c, links.text).encode()).hexdigest() if len(c) else "" for c in codes]
            size, packed = _packed([*figures, np.array([len(c) for c in codes]), np.concatenate(codes),
                                    np.bincount(links.unit, minlength=len(links.n_a)), place, links.times])
            columns = [[(TaskContext.get().partitionId() << 32) + number], [[i for i, _ in chunk.docs]], [digest], [pairs],
                       [_holders(codes, links.unit, place, len(pairs))], [size], [packed]]
            # Nothing of this chunk stays while the next one is made.
            del chunk, links, codes, place, pairs, packed
            row = pa.RecordBatch.from_arrays([pa.array(columns.pop(0), f.type) for f in schema], schema=schema)
            yield row
            del row

    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split(" ") for f in _CHUNKS.split(", ")]
    schema = pa.schema([(n, pa.list_(types[t[6:-1]]) if t.startswith("array") else types[t]) for n, t in fields])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, _CHUNKS)


def _holders(codes: list[np.ndarray], unit: np.ndarray, place: np.ndarray, pairs: int) -> np.ndarray:
    """Of each pair, how many documents have a unit with it; ``unit`` is in order."""
    total = np.zeros(pairs, np.int64)
    starts = np.searchsorted(unit, np.arange(int(unit[-1]) + 2 if len(unit) else 1))
    at, sizes = 0, np.array([len(c) for c in codes])
    while at < len(codes):
        # As many documents as have LOOKUP_UNITS units together.
        to = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), LOOKUP_UNITS)))
        doc = np.repeat(np.arange(to - at, dtype=np.int64), sizes[at:to])
        own = np.unique((doc << 32) | np.concatenate(codes[at:to]))
        doc, code = own >> 32, own & 0xFFFFFFFF
        width = starts[code + 1] - starts[code]
        index = np.repeat(starts[code], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        held = np.unique((np.repeat(doc, width) << 32) | place[index])
        total += np.bincount(held & 0xFFFFFFFF, minlength=pairs)
        at = to
    return total


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many documents an id pair is linked, and whether no pair of its A id is in more."""
    pairs = chunks.select(F.explode(F.arrays_zip("pair", "pair_docs")).alias("p"))
    counts = kept(pairs.groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.pair_docs").alias("n")), "pair-counts")
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def document_alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``docs``.

    A encodes a space and the text, B the text, to which it adds that space. Texts
    that are null or empty, or whose tokens don't give their bytes back on both
    sides, have no tokens: zeros and an empty digest. ``n_links`` counts places; an
    id pair's count is the number of rows that hold it linked. ``n_best`` counts the
    links whose pair's count is the highest of its A id, ties included;
    ``count_sum`` sums the counts over links. Rows that repeat a ``doc_id`` count as
    further documents, rows without ``doc_id`` too; other columns are not read.
    """
    chunks = kept(_chunks(docs, a_path, b_path), "token-chunks")
    places = chunks.select("chunk", F.posexplode("pair").alias("place", "pair"))
    counts = places.join(pair_counts(chunks), "pair").select(
        F.col("chunk").alias("home"), "place", "n", "best")
    own = chunks.select("chunk", "doc_id", "digest", "size", "packed")

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        row = dict(zip(left.column_names, left.combine_chunks().to_batches()[0].columns))
        *figures, n_units, units, n_pairs, pair, times = _unpacked(row["size"][0].as_py(), row["packed"][0].as_py(), 9)
        place, of_unit = right.column("place").to_numpy(), np.repeat(np.arange(len(n_pairs)), n_pairs)
        sums = []
        for name in ("best", "n"):
            of_pair = np.zeros(right.num_rows, np.int64)
            of_pair[place] = right.column(name).to_numpy()
            total = np.zeros(len(n_pairs), np.int64)
            np.add.at(total, of_unit, times * of_pair[pair])
            running = np.concatenate([[0], np.cumsum(total[units])])
            sums.append(np.diff(running[np.concatenate([[0], np.cumsum(n_units)])]))
        return pa.table([row["doc_id"].flatten(), *figures, *sums, row["digest"].flatten()], names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return own.groupBy("chunk").cogroup(counts.groupBy("home")).applyInArrow(
        rows, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names))
