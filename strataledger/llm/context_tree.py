"""Context-tree weighting over the bytes of running text.

A text is its words and one end, each closed by a space. The context of a byte are the DEPTH bytes before it; with
``across`` they run on over the spaces into the words before, and spaces stand before the text. Without ``across`` contexts
stop at the start of the word, so that a word's probability does not depend on its neighbours. Every byte is eight binary
decisions. Each decision node has a context tree of its own, whose nodes hold Krichevsky-Trofimov estimates; the weighted probability of
a node is the even mixture of its own estimate and the product of its children's. The probability of the next bit is
the ratio of weighted probabilities with and without it, which is a mixture of the estimates along the context
path, with the posterior weights of cutting the tree at each depth. Contexts that training lacks end the path.

Events are pairs of context and byte, packed in one integer with the nearest byte highest, so that all
contexts of a subtree are neighbours in sorted order. Every byte of every row is an event; tasks count them in sorted runs. The tree is
summed up bottom-up in tasks that own all contexts with the same last SHALLOW bytes, some subtrees at a time; the levels above (the
contexts of SHALLOW bytes that occur, for each of 255 decisions) are summed up per decision; then the tasks go down again and
give every event its probability.

Corpus counts cover all training rows. At most ``TOP`` of the most frequent words and ``LOCAL_EVENTS`` of the most frequent
events (12 bytes each) are sent to the tasks that read documents; all others are looked up through joins, so the result does not depend on
these numbers. Texts are spelled in windows of WINDOW bytes that overlap by their contexts, so a long one is no larger array.

Defined results: a null or empty text is the end alone. Repeated rows, also with equal or null ids, count
and are scored repeatedly. Without training rows every bit has probability one half. An empty table gives no rows.
Only id, text and the training condition are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataledger.llm.common import blocks, record_batch, stored, utf8

DEPTH = 6
SHALLOW = 3
END = b"\n"  # no word contains it
TOP = 200_000
LOCAL_EVENTS = 4_000_000
WINDOW = 1 << 20
# Distinct words, and distinct events, that a task sums up before it passes them on.
HELD = 400_000
HELD_EVENTS = 3_000_000
# Events that a task sorts at once, and events whose subtrees it holds at once (more if they are one subtree).
RUN = 2_000_000
SUBTREES = 100_000
NO_EVENT = np.iinfo(np.int64).max
LOG10 = math.log(10)


# Counting


def word_counts(docs: DataFrame, training: Column) -> DataFrame:
    """Columns word and n: how often each word of any row occurs in the training rows. The end is a word."""

    def count(batches):
        schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        seen, other = Counter(), set()

        def held():
            yield record_batch(schema, [list(seen), list(seen.values())])
            yield record_batch(schema, [list(other), [0] * len(other)])
            seen.clear()
            other.clear()

        for batch in blocks(batches):
            for text, learn in zip(utf8(batch.column("text")), batch.column("training").to_pylist()):
                words = text.lower().split()
                words.append(END)
                if learn:
                    seen.update(words)
                else:
                    other.update(words)
            if len(seen) + len(other) > HELD:
                yield from held()
        yield from held()

    rows = docs.select("text", training.alias("training")).mapInArrow(count, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def windows_of(words: list[bytes], across: bool) -> list[bytes]:
    """The spelled words, cut into windows; the first DEPTH bytes of each are context only."""
    pad = b" " * DEPTH
    spelled = [pad + b" ".join(words) + b" "] if across else [pad + word + b" " for word in words]
    return [text[at : at + WINDOW + DEPTH] for text in spelled for at in range(0, len(text) - DEPTH, WINDOW)]


def events_of(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All events of the windows, and how many each has."""
    data = np.frombuffer(b"".join(windows), np.uint8).astype(np.int64)
    sizes = np.array([len(w) for w in windows])
    key = data[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        key |= data[DEPTH - back : len(data) - back] << (8 * (DEPTH + 1 - back))
    spelled = np.ones(len(data), bool)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    for place in range(DEPTH):
        spelled[starts + place] = False
    return key[spelled[DEPTH:]], sizes - DEPTH


def spelled_in(texts: list[list[bytes]], across: bool):
    """Windows of the texts' words in groups of about WINDOW bytes, and the number of each window's text."""
    held, owners, size = [], [], 0
    for number, words in enumerate(texts):
        for window in windows_of(words, across):
            held.append(window)
            owners.append(number)
            size += len(window)
            if size >= WINDOW:
                yield held, owners
                held, owners, size = [], [], 0
    if held:
        yield held, owners


def words_of(text: bytes) -> list[bytes]:
    """Words and the end."""
    return [*text.lower().split(), END]


class Tally:
    """Distinct events and their counts in sorted order; events of other rows count zero."""

    def __init__(self):
        self.events, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: dict[bool, list[np.ndarray]] = {True: [], False: []}
        self.size = 0

    def add(self, events: np.ndarray, learn: bool) -> None:
        self.waiting[learn].append(events)
        self.size += len(events)
        if self.size >= RUN:
            self.fold()

    def fold(self) -> None:
        runs, counts = [self.events], [self.n]
        for learn, waiting in self.waiting.items():
            if waiting:
                found, n = np.unique(np.concatenate(waiting), return_counts=True)
                runs.append(found)
                counts.append(n if learn else np.zeros(len(found), np.int64))
            waiting.clear()
        events = np.concatenate(runs)
        order = np.argsort(events, kind="stable")  # merges the runs
        events = events[order]
        first = np.flatnonzero(np.diff(events, prepend=-1))
        self.events, self.size = events[first], 0
        self.n = np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else self.n


def event_counts(docs: DataFrame, training: Column, across: bool) -> DataFrame:
    """Columns event and n: how often each event of any row occurs in the training rows."""

    def count(batches):
        schema = pa.schema([("event", pa.int64()), ("n", pa.int64())])
        tally = Tally()

        def held():
            tally.fold()
            for at in range(0, len(tally.events), HELD):
                yield record_batch(schema, [tally.events[at : at + HELD], tally.n[at : at + HELD]])

        for batch in blocks(batches):
            learn = np.array(batch.column("training").to_pylist(), bool)
            texts = utf8(batch.column("text"))
            for side in (True, False):
                for windows, _ in spelled_in([words_of(texts[i]) for i in np.flatnonzero(learn == side)], across):
                    tally.add(events_of(windows)[0], side)
            if len(tally.events) > HELD_EVENTS:
                yield from held()
                tally = Tally()
        yield from held()

    rows = docs.select("text", training.alias("training")).mapInArrow(count, "event long, n long")
    # A task's events are distinct already: they are dealt before they are summed up.
    return rows.repartition("event").groupBy("event").agg(F.sum("n").alias("n"))


# The tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight."""
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    y = x + 8
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / y**2) / y**2) / y**2) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    small = (zeros + ones) < 1e12
    result = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)
    return np.where(small & (zeros + ones == 0), 0.0, result)


def one_share(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


class Level:
    """Decision nodes of all contexts of one depth; a node's id is its context, then its place in the byte."""

    def __init__(self, ids, zeros, ones, below=None):
        self.ids, self.zeros, self.ones = ids, zeros, ones
        own = estimate(zeros, ones)
        self.weighted = own if below is None else np.logaddexp(own, below) - math.log(2)
        self.cut = np.ones(len(ids)) if below is None else np.exp(own - math.log(2) - self.weighted)
        self.share = one_share(zeros, ones)
        self.empty = (zeros + ones) == 0

    def parents(self) -> tuple[Level, np.ndarray]:
        """The level above, and each node's parent in it."""
        ids, place = np.unique(((self.ids >> 16) << 8) | (self.ids & 255), return_inverse=True)
        sums = [np.bincount(place, weights=w, minlength=len(ids)) for w in (self.zeros, self.ones, self.weighted)]
        return Level(ids, *sums), place

    def descend(self, before, rate, place, child: Level) -> tuple[np.ndarray, np.ndarray]:
        """For the children: probability of a one is the first result plus the second times their own."""
        stop = child.empty
        cut = np.where(stop, 1.0, self.cut[place])
        before, rate = before[place], rate[place]
        return before + rate * cut * self.share[place], np.where(stop, 0.0, rate * (1 - cut))


def leaves(events: np.ndarray, n: np.ndarray) -> tuple[Level, np.ndarray]:
    """Nodes of the deepest contexts, and the nodes of each event's eight decisions."""
    context, byte = events >> 8, events & 255
    nodes = np.concatenate([(context << 8) | (1 << k) | (byte >> (8 - k)) for k in range(8)])
    bits = np.concatenate([(byte >> (7 - k)) & 1 for k in range(8)])
    ids, place = np.unique(nodes, return_inverse=True)
    weights = np.tile(n.astype(np.float64), 8)
    zeros = np.bincount(place, weights=weights * (bits == 0), minlength=len(ids))
    ones = np.bincount(place, weights=weights * (bits == 1), minlength=len(ids))
    return Level(ids, zeros, ones), place


def climb(events: np.ndarray, n: np.ndarray) -> tuple[list[Level], list[np.ndarray], np.ndarray]:
    """Levels from DEPTH up to SHALLOW, each one's parents, and the events' nodes."""
    level, of_event = leaves(events, n)
    levels, parents = [level], []
    for _ in range(DEPTH - SHALLOW):
        level, place = level.parents()
        levels.append(level)
        parents.append(place)
    return levels, parents, of_event


def event_scores(events: np.ndarray, n: np.ndarray, ids: np.ndarray, before: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """log10 probability of every event; ``ids, before, rate`` describe what the upper levels say."""
    levels, parents, of_event = climb(events, n)
    order = np.argsort(ids)
    at = order[np.searchsorted(ids[order], levels[-1].ids)]
    before, rate = before[at], rate[at]
    for depth in range(len(parents) - 1, -1, -1):
        before, rate = levels[depth + 1].descend(before, rate, parents[depth], levels[depth])
    one = before + rate * levels[0].share
    byte = events & 255
    bits = np.concatenate([(byte >> (7 - k)) & 1 for k in range(8)])
    chosen = np.where(bits == 1, one[of_event], 1 - one[of_event])
    return np.log10(chosen).reshape(8, -1).sum(axis=0)


def shallow_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """What the levels above SHALLOW say to its nodes; all nodes of one decision."""
    rows = rows.sort_values("id")
    level = Level(rows["id"].to_numpy(), rows["zeros"].to_numpy(), rows["ones"].to_numpy())
    level.weighted = rows["weighted"].to_numpy()
    levels, parents = [level], []
    for _ in range(SHALLOW):
        level, place = level.parents()
        levels.append(level)
        parents.append(place)
    before, rate = np.zeros(len(level.ids)), np.ones(len(level.ids))
    for depth in range(SHALLOW - 1, -1, -1):
        before, rate = levels[depth + 1].descend(before, rate, parents[depth], levels[depth])
    return pd.DataFrame({"id": levels[0].ids, "before": before, "rate": rate})


def gathered(batches) -> dict[str, np.ndarray]:
    """A partition's columns; partitions hold whole subtrees."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return {}
    whole = pa.Table.from_batches(batches)
    return {name: whole.column(name).to_numpy() for name in whole.column_names}


def subtrees(events: np.ndarray):
    """Places of the events of whole subtrees, about SUBTREES of them at a time, and the first and last subtree."""
    order = np.argsort(events)
    tails = events[order] >> (8 * (DEPTH + 1 - SHALLOW))
    ends = np.append(np.flatnonzero(np.diff(tails)) + 1, len(tails))
    start = 0
    while start < len(order):
        stop = ends[min(np.searchsorted(ends, start + SUBTREES), len(ends) - 1)]
        yield order[start:stop], tails[start], tails[stop - 1]
        start = stop


def event_probabilities(events: DataFrame) -> DataFrame:
    """Adds column score (log10) to all events (event, n)."""
    tail = F.shiftright("event", 8 * (DEPTH + 1 - SHALLOW)).alias("tail")
    split = events.select(tail, "event", "n")

    def up(batches):
        rows = gathered(batches)
        names = [("id", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("weighted", pa.float64())]
        for own, _, _ in subtrees(rows["event"]) if rows else ():
            top = climb(rows["event"][own], rows["n"][own])[0][-1]
            yield record_batch(pa.schema(names), [top.ids, top.zeros, top.ones, top.weighted])

    upper = split.repartition("tail").mapInArrow(up, "id long, zeros double, ones double, weighted double")
    decision = F.col("id").bitwiseAND(255).alias("decision")
    said = upper.groupBy(decision).applyInPandas(shallow_rows, "id long, before double, rate double")
    both = split.select("tail", "event", "n", F.lit(None).cast("double").alias("before"), F.lit(None).cast("double").alias("rate"))
    both = both.union(said.select(F.shiftright("id", 8).alias("tail"), "id", F.lit(-1).cast("long"), "before", "rate"))

    def down(batches):
        rows = gathered(batches)
        if rows:
            own, upper = rows["n"] >= 0, rows["n"] < 0
            order = np.argsort(rows["event"][upper])
            ids, before, rate = (rows[name][upper][order] for name in ("event", "before", "rate"))
            events, n = rows["event"][own], rows["n"][own]
            schema = pa.schema([("event", pa.int64()), ("n", pa.int64()), ("score", pa.float32())])
            for at, first, last in subtrees(events):
                said = slice(*np.searchsorted(ids, [first << 8, (last + 1) << 8]))
                scores = event_scores(events[at], n[at], ids[said], before[said], rate[said])
                yield record_batch(schema, [events[at], n[at], scores.astype(np.float32)])

    return both.repartition("tail").mapInArrow(down, "event long, n long, score float")


def frequent_events(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most LOCAL_EVENTS of the most frequent events and their scores, in the order of the events; one beyond all ends them."""
    if model.count() > LOCAL_EVENTS:
        model = model.where(F.col("n") >= frequent_from(model, LOCAL_EVENTS))
    rows = model.select("event", "score").toArrow()
    events = rows.column("event").to_numpy()
    order = np.argsort(events)
    return np.append(events[order], NO_EVENT), np.append(rows.column("score").to_numpy()[order], np.float32(0))


def spelled_scores(texts: list[list[bytes]], across: bool, events: np.ndarray, scores: np.ndarray):
    """The sum of the known events' scores of each text; and the other events: their text, event and times."""
    total, rest = np.zeros(len(texts)), []
    for windows, owners in spelled_in(texts, across):
        found, sizes = events_of(windows)
        different, place = np.unique(found, return_inverse=True)
        at = np.searchsorted(events, different)
        known = events[at] == different
        each = np.where(known, scores[at], 0.0)[place]
        text = np.repeat(owners, sizes)
        total += np.bincount(text, weights=each, minlength=len(texts))
        if not known.all():
            other = np.flatnonzero(~known[place])
            pairs, times = np.unique(text[other] * len(different) + place[other], return_counts=True)
            rest.append((pairs // len(different), different[pairs % len(different)], times))
    if not rest:
        rest = [(np.empty(0, np.int64),) * 3]
    return total, tuple(np.concatenate(parts) for parts in zip(*rest))


# Documents


def frequent_from(counted: DataFrame, most: int) -> int:
    """The smallest power of the fourth root of two that at most ``most`` rows reach; found from a histogram."""
    step = F.floor(F.log2(F.col("n") + 0.5) * 4)
    sizes = counted.where("n > 0").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"))
    total, least = 0, 1 << 62
    for row in sorted(sizes.collect(), reverse=True):  # at most 4 * 63 rows
        total += row["rows"]
        if total > most:
            break
        least = math.ceil(2 ** (row["step"] / 4) - 0.5)
    return least


def score(docs: DataFrame, training: Column, across: bool = False) -> DataFrame:
    """Every row scored by a model of the rows where ``training`` holds; ``across``: contexts reach over the spaces.

    Columns: doc_id, training, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the whole
    text) and bits_per_byte, the code length of the text under the tree for each byte of words and separators.
    """
    learn = F.coalesce(training, F.lit(False))
    words = stored(word_counts(docs, learn), "words")
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    model = stored(event_probabilities(stored(event_counts(docs, learn, across), "events")), "event_scores")
    floor = math.log10(tokens + 0.1 * (kinds + 1))
    ends = [r["n"] for r in words.where(F.col("word") == F.lit(END)).collect()]
    end_n = ends[0] if ends else 0
    top = words.where(F.col("n") >= frequent_from(words, TOP)).toArrow()
    known_words = {w: i for i, w in enumerate(top.column("word").to_pylist())}
    counts = top.column("n").to_numpy()
    local = (known_words, counts > 0, np.log10(counts + 0.1) - floor, *frequent_events(model))
    shared = docs.sparkSession.sparkContext.broadcast(local)  # TOP words, LOCAL_EVENTS events
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    fields = [("training", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("size", pa.int64())]
    fields += [("base", pa.float64()), ("score", pa.float64()), ("word", pa.binary()), ("event", pa.int64()), ("times", pa.int64())]
    names = "row long, training boolean, n_tokens long, n_known long, size long, base double, score double"

    def read(batches):
        index, is_known, base, events, scores = shared.value
        find = index.get
        number = TaskContext.get().partitionId() << 40
        for batch in blocks(batches):
            rows, rest_rows, rest_words, rest_times = [], [], [], []
            texts = [words_of(text) for text in utf8(batch.column("text"))]
            spelled, (owner, other, times) = spelled_scores(texts, across, events, scores)
            first = number
            for words in texts:
                size = sum(map(len, words)) + len(words)
                words = words[:-1]
                places = np.array([find(w, -1) for w in words], np.int64)
                rare = Counter([words[i] for i in np.flatnonzero(places < 0)])
                places = places[places >= 0]
                rows.append((number, len(words) + 1, is_known[places].sum(), size, base[places].sum()))
                rest_rows += [number] * len(rare)
                rest_words += rare
                rest_times += rare.values()
                number += 1
            row, n, known, size, sums = zip(*rows)
            ids = batch.column("doc_id")
            schema = pa.schema([("doc_id", ids.type), ("row", pa.int64()), *fields])
            nothing = [None] * len(rows)
            yield record_batch(schema, [ids, row, batch.column("training"), n, known, size, sums, spelled, *[nothing] * 3])
            blank = [None] * len(rest_rows)
            yield record_batch(schema, [blank, rest_rows, *[blank] * 6, rest_words, blank, rest_times])
            blank = [None] * len(other)
            if len(other):
                yield record_batch(schema, [blank, first + owner, *[blank] * 7, other, times])

    passed = docs.select("doc_id", "text", learn.alias("training")).mapInArrow(
        read, f"doc_id {doc_type}, {names}, word binary, event long, times long"
    )
    passed = stored(passed, "documents")
    rare = passed.where("word is not null").select("row", "word", "times").join(words, "word")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * (F.log10(F.col("n") + 0.1) - floor)).alias("rare_base"),
    )
    others = passed.where("event is not null").select("row", "event", "times").join(model, "event")
    others = others.groupBy("row").agg(F.sum(F.col("times") * F.col("score").cast("double")).alias("rare_score"))
    found = passed.where("word is null and event is null")
    found = found.join(rare, "row", "left").join(others, "row", "left")
    plus = lambda column, more: F.col(column) + F.coalesce(more, F.lit(0))
    total = plus("score", "rare_score")
    return found.select(
        "doc_id",
        "training",
        "n_tokens",
        (plus("n_known", "rare_known") + F.lit(int(end_n > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (plus("base", "rare_base") + F.lit(math.log10(end_n + 0.1) - floor)).alias("base_score"),
        total.alias("score"),
        (-total * F.lit(math.log2(10)) / F.col("size")).alias("bits_per_byte"),
    )
