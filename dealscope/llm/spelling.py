"""Spelling variants: words of a corpus that differ by one inserted, deleted or replaced letter.

The vocabulary is an acyclic acceptor; a pair of near words is a path of the
composition vocabulary, one-edit transducer, vocabulary. The composition is
enumerated in partitions of its initial states. For words of m letters (and of
m + 1, for insertions) and an interval [lo, hi) of places for the edit, the words
that agree before and after the interval start in one state, reached by these
letters; what is left of them, the free part, is a small language of its own. Two
intervals cover all places; where a partition holds more than GROUP words, its
interval is halved, down to single places, which the alphabet bounds. In a task the
free parts of a partition are minimised into one acceptor and composed with the
transducer: both sides run together, make their edit, and run on together; where
they meet in one state of the minimised acceptor, all that follows is accepted.

A task passes on one row a word with its near words counted and the best of them,
never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.tables import kept

#: Words of a partition that one task composes at once; more than single places can hold (88 + 88 * 88).
GROUP = 20_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000
_KEY = ["m", "lo", "hi", "rest"]


def word_counts(docs: DataFrame, least_letters: int, noise: int | None) -> DataFrame:
    """``word, n``: maximal runs of letters of at least that many, A-Z lower-cased, and how often they occur.

    With ``noise`` every run whose checksum with the document's id it divides first
    loses one letter, so the counts have misspellings in them.
    """
    letters = re.compile(f"[A-Za-zÀ-ÿ]{{{least_letters},}}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if (text := text.as_py()) is None:
                    continue
                own = Counter(letters.findall(text.encode().lower().decode()))
                if noise is None:
                    total.update(own)
                else:
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for run, n in own.items():
                        check = zlib.crc32(run.encode(), start)
                        if check % noise == 0:
                            at = check % len(run)
                            run = run[:at] + run[at + 1:]
                        total[run] += n
                if len(total) > HELD_WORDS:
                    yield out()
        yield out()

    return docs.select("doc_id", "text").mapInArrow(rows, "word string, n long").where(
        F.length("word") >= least_letters).groupBy("word").agg(F.sum("n").alias("n"))


def _part(lo, hi, is_long):
    """Free part and rest of a word whose edit lies in [lo, hi); the longer word of a pair has one letter more there."""
    width = hi - lo + F.when(is_long, 1).otherwise(0)
    free = F.substring(F.col("word"), lo + 1, width)
    rest = F.concat(F.substring(F.col("word"), F.lit(1), lo),
                    F.substring(F.col("word"), lo + width + 1, F.greatest(F.length("word") - lo - width, F.lit(0))))
    return free, rest


def _views(words: DataFrame, spans) -> DataFrame:
    """``words`` (word, n, m, is_long) once for each of the ``spans`` (lo, hi) of their edit."""
    rows = words.withColumn("span", F.explode(spans))
    lo, hi = F.col("span.lo"), F.col("span.hi")
    free, rest = _part(lo, hi, F.col("is_long"))
    return rows.select("m", lo.alias("lo"), hi.alias("hi"), rest.alias("rest"), "is_long", "word", "n", free.alias("free"))


def _halves(lo, middle, hi):
    return F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))


def partitions(vocabulary: DataFrame, group: int = GROUP) -> DataFrame:
    """``m, lo, hi, rest, is_long, word, n, free``: each word in its partitions, none of them over ``group`` words."""
    length = F.length("word").cast("int")
    roles = vocabulary.withColumn("role", F.explode(F.array(
        F.struct(length.alias("m"), F.lit(False).alias("is_long")),
        F.struct((length - 1).alias("m"), F.lit(True).alias("is_long")))))
    m = F.col("m")
    rows = _views(roles.select("word", "n", "role.m", "role.is_long").where("m > 0"),
                  _halves(F.lit(0), F.floor(m / 2).cast("int"), m + 1))
    done = None
    while True:
        rows = kept(rows, "partitions")
        hot = kept(rows.groupBy(*_KEY).count().where(F.col("count") > group).where("hi - lo > 1").select(*_KEY), "hot")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cold = rows.join(hot, _KEY, "left_anti").select(*rows.columns)
        done = cold if done is None else done.unionByName(cold)
        lo, hi = F.col("lo"), F.col("hi")
        rows = _views(rows.join(hot, _KEY, "left_semi").select("word", "n", "m", "is_long", "lo", "hi"),
                      _halves(lo, F.floor((lo + hi) / 2).cast("int"), hi))


class Acceptor:
    """Minimised acyclic acceptors of word lists, in one table of states.

    A state is a dict from letter to (next state, words accepted by smaller
    letters), so a path also gives the word's number. State 0 accepts the empty word.
    """

    def __init__(self):
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.size = [1]
        self._known: dict[tuple, int] = {}

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        if (state := self._known.get(key)) is None:
            self._known[key] = state = len(self.arcs)
            total, out = 0, {}
            for letter, target in arcs:
                out[letter] = (target, total)
                total += self.size[target]
            self.arcs.append(out)
            self.size.append(total)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state for distinct words of one length, in order."""
        length = len(words[0])
        if not length:
            return 0
        open_arcs: list[list[tuple[str, int]]] = [[] for _ in range(length)]
        last = ""
        for word in [*words, None]:
            # The states below the common start with the next word are complete.
            same = 0
            if word is not None:
                while same < len(last) and last[same] == word[same]:
                    same += 1
            if last:
                state = 0
                for depth in range(length - 1, same - 1, -1):
                    open_arcs[depth].append((last[depth], state))
                    if depth > same or word is None:
                        state = self._state(open_arcs[depth])
                        open_arcs[depth] = []
            last = word
        return state

    def met(self, left: int, right: int, i: int, j: int, out: list[tuple[int, int, int]]) -> None:
        """Runs of pairs (i, j, count) of words that both states accept."""
        todo = [(left, right, i, j)]
        while todo:
            p, q, i, j = todo.pop()
            if p == q:
                out.append((i, j, self.size[p]))
                continue
            other = self.arcs[q]
            for letter, (target, before) in self.arcs[p].items():
                if (arc := other.get(letter)) is not None:
                    todo.append((target, arc[0], i + before, j + arc[1]))

    def replaced(self, start: int) -> list[tuple[int, int, int]]:
        """Pairs of words of ``start`` that differ in one letter."""
        out: list[tuple[int, int, int]] = []
        todo = [(start, 0)]
        while todo:
            state, base = todo.pop()
            arcs = list(self.arcs[state].values())
            for k, (target, before) in enumerate(arcs):
                todo.append((target, base + before))
                for other, more in arcs[k + 1:]:
                    self.met(target, other, base + before, base + more, out)
        return out

    def inserted(self, short: int, long: int, at_end: bool) -> list[tuple[int, int, int]]:
        """Pairs of a word of ``short`` and one of ``long`` that has one letter more.

        Of several places for that letter the first counts: the word of ``short``
        goes on with another letter there, or, if ``at_end``, ends.
        """
        out: list[tuple[int, int, int]] = []
        todo = [(short, long, 0, 0)]
        while todo:
            p, q, i, j = todo.pop()
            mine, other = self.arcs[p], self.arcs[q]
            for extra, (after, before) in other.items():
                if not mine:
                    if at_end:
                        out.append((i, j + before, 1))
                    continue
                follow = self.arcs[after]
                for letter, (target, skipped) in mine.items():
                    if letter != extra and (arc := follow.get(letter)) is not None:
                        self.met(target, arc[0], i + skipped, j + before + arc[1], out)
            for letter, (target, before) in mine.items():
                if (arc := other.get(letter)) is not None:
                    todo.append((target, arc[0], i + before, j + arc[1]))
        return out


def near_pairs(shorts: list[str], longs: list[str], at_end: bool) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Runs of near pairs among ``shorts``, and of ``shorts`` with ``longs``; both in order, of one length each."""
    if not shorts or len(shorts) + len(longs) < 2:
        return [], []
    table = Acceptor()
    start = table.add(shorts)
    among = table.replaced(start) if len(shorts) > 1 else []
    return among, table.inserted(start, table.add(longs), at_end) if longs else []


def _pairs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words in a batch that holds whole partitions, in order."""
    m, lo, hi = (np.asarray(batch.column(c)) for c in range(3))
    rest = batch.column(3)
    is_long = batch.column(4).to_numpy(zero_copy_only=False)
    free = batch.column(7).to_pylist()
    count = len(m)
    new = np.ones(count, bool)
    if count > 1:
        same_rest = rest.slice(1).to_numpy(zero_copy_only=False) == rest.slice(0, count - 1).to_numpy(zero_copy_only=False)
        new[1:] = (m[1:] != m[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | ~same_rest
    first = np.flatnonzero(new)
    ends = np.append(first[1:], count)
    runs = []
    # Partitions of one word, and of long ones only, have no pairs.
    for a, b in zip(first[(ends - first > 1) & ~is_long[first]].tolist(), ends[(ends - first > 1) & ~is_long[first]].tolist()):
        middle = a + int((~is_long[a:b]).sum())
        among, between = near_pairs(free[a:middle], free[middle:b], int(hi[a]) > int(m[a]))
        runs += [(a + i, a + j, n) for i, j, n in among] + [(a + i, middle + j, n) for i, j, n in between]
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j, n = np.array(runs, np.int64).T
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(i, n) + step, np.repeat(j, n) + step


def near_words(views: DataFrame) -> DataFrame:
    """``word, n_near, near_n, near``: how many near words a word has, and the one of them that occurs most."""
    def best(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        i, j = _pairs_of(batch)
        if not len(i):
            return
        word, n = batch.column(5), np.asarray(batch.column(6))
        names = word.to_numpy(zero_copy_only=False)
        order = np.lexsort((names, -n))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        many = np.bincount(i, minlength=len(n)) + np.bincount(j, minlength=len(n))
        top = np.full(len(n), len(n))
        np.minimum.at(top, i, place[j])
        np.minimum.at(top, j, place[i])
        own = np.flatnonzero(many)
        other = order[top[own]]
        yield pa.RecordBatch.from_arrays(
            [word.take(pa.array(own)), pa.array(many[own]), pa.array(n[other]), word.take(pa.array(other))],
            ["word", "n_near", "near_n", "near"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last partition of a batch may go on in the next one: it waits.
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in range(4)]
            start = batch.num_rows - 1
            while start and [batch.column(c)[start - 1].as_py() for c in range(4)] == last:
                start -= 1
            if start:
                yield from best(_joined([*held, batch.slice(0, start)]))
                held = []
            held.append(batch.slice(start))
        if held:
            yield from best(_joined(held))

    dealt = views.repartition(*_KEY).sortWithinPartitions(*_KEY, "is_long", "word")
    found = dealt.mapInArrow(rows, "word string, n_near long, near_n long, near string")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the rows of ``forms`` (word, form) with a form: where following forms ends.

    Each round doubles the steps taken. A form occurs several times as often as its
    word, so chains are no longer than the digits of the largest count.
    """
    links = kept(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = kept(links.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, least_letters: int = 7, least_count: int = 2, times: int = 10,
                      noise: int | None = None, group: int = GROUP) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each word that occurs ``least_count`` times or more.

    Words are the maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF of at
    least ``least_letters`` code points, A-Z lower-cased; ``n`` counts them over all
    rows of ``docs`` (``doc_id``, ``text``), repeated ones too. ``n_near`` counts the
    words that differ by one inserted, deleted or replaced code point. The near word
    of largest count (of equal ones the smallest in code-point order) is the ``form``
    if it occurs at least ``times`` times as often, else null; ``root`` follows forms
    to the last one. Null and empty texts have no words; rows without ``doc_id``
    count. Further columns are not read. ``noise``: see ``word_counts``.
    """
    counted = word_counts(docs, least_letters, noise).where(F.col("n") >= least_count)
    vocabulary = kept(counted, "vocabulary")
    near = near_words(partitions(vocabulary, group))
    is_form = F.col("near_n") >= F.lit(times) * F.col("n")
    formed = kept(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
