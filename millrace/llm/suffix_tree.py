"""Language-model scoring with a probabilistic suffix tree.

Symbols are all words and the end of a text. A context of one to ``depth`` words that stands ``least`` times or more in
the training part is kept as a state if the distribution of the next symbol differs from that of its suffix by more than
its size explains (gain in log likelihood against half the log of the corpus size per next symbol seen), or if a longer
state ends with it. Each context is smoothed towards its suffix (Witten-Bell), the root being the smoothed word counts;
a word that training does not have gets half a count. A text is scored with the longest suffix of its history that is a
state.

No task and no driver holds the model: it grows with the input and stays dealt out. Chunks of documents send each distinct
word, (context, next) pair and context once, with what they know of it, to the bucket of its hash, and get the corpus'
counts, sums and states for their own tokens. Every round goes one word deeper, below contexts that are frequent enough.
The chunks are written once, as token numbers, in buckets of a table, so that a round shuffles requests and replies only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import chunks
from millrace.llm.gather import CHUNK_BYTES
from millrace.llm.words import STEPS, U, mix, slices, stream
from millrace.runtime import work_path

FINE = 1 << 24  # steps in which chunks tell gains, so that their sum does not depend on the order
PENALTY = 0.5  # of the log of the corpus size, per next symbol of a state
END = U(stream(9, 1)[0])  # stands for the end of a text among word hashes


def tokens(col) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a column of texts, the end of each included, and the text number of each."""
    hashes, docs = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for i, j, w in slices(col, lower=True):
        at = w.first[1:]  # where each text's end goes
        hashes.append(np.insert(w.hashes(), at, END))
        docs.append(i + np.insert(w.doc, at, np.arange(j - i)))
    return np.concatenate(hashes), np.concatenate(docs)


class Walk:
    """A chunk's tokens against what the corpus has said so far.

    Level L has the tokens whose context of L words stands ``least`` times or more in the training part. A round asks
    for the counts of level L's (context, next) pairs and for the sums of level L - 1's contexts; the last one for
    states. Slots number these questions, and each has ``buckets`` buckets.
    """

    def __init__(self, mine: pa.Table, theirs: pa.Table | None, buckets: int, depth: int, least: int, size: float):
        self.buckets, self.depth, self.least, self.chunk = buckets, depth, least, mine.column("chunk")[0].as_py()
        mine = mine.sort_by("piece")
        data = mine.column("data").to_pylist()
        self.words, self.at = chunks.unpacked_keys(data[0]), np.concatenate([chunks.unpacked(x) for x in data[1:]])
        self.ids, self.held, sizes = (mine.column(c).combine_chunks().flatten() for c in ("ids", "held", "sizes"))
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.train = ~self.held.to_numpy(zero_copy_only=False)[self.doc]
        if theirs is not None:
            self.theirs, self.slots = theirs, theirs.column("bucket").to_numpy() // buckets
            self.h = self.words[self.at]
            self.count = self.answers(0)[self.at]
            self.root = (self.count + 0.5) / size
            self.p = self.root.copy()  # after the longest context whose sums are known
            self.levels = []

    def answers(self, slot: int) -> np.ndarray:
        return chunks.answers(self.theirs.filter(pa.array(self.slots == slot)))

    def requests(self, slot: int, keys: np.ndarray, *vals: np.ndarray) -> pa.Table:
        return chunks.requests(self.chunk, keys, list(vals), self.buckets, slot)

    def ask_words(self) -> pa.Table:
        return self.requests(0, self.words, np.bincount(self.at[self.train], minlength=len(self.words)))

    def ask(self, level: int, send: bool = True) -> pa.Table | None:
        """Requests of round ``level``: 1 to depth + 1, and depth + 2 for the states; nothing if only to know all levels."""
        keys, index, n, out = self.words, self.at, self.count, []  # of the pairs that end at each token, one level below
        inside = self.doc[1:] == self.doc[:-1]
        for k in range(1, min(level, self.depth) + 1):
            seen = np.zeros(len(n), np.int64)
            seen[1:] = np.where(inside, n[:-1], 0)  # occurrences of the context: it is the pair that ends one token before
            at = np.flatnonzero(seen >= self.least)
            before = index[at - 1]
            used = np.zeros(len(keys), bool)
            used[before] = True
            contexts, of = keys[used], (np.cumsum(used) - 1)[before]
            pairs, pair = chunks.distinct(mix(keys[before] * STEPS[0] + self.h[at] * STEPS[1]))
            keys, index = pairs, np.full(len(n), -1)
            index[at] = pair
            if k == level:
                train = self.train[at]
                out.append(self.requests(k, pairs, np.bincount(pair[train], minlength=len(pairs))))
                break
            said = self.answers(k)
            n = np.zeros(len(index), np.int64)
            n[at] = (said >> 1)[pair]
            slot = self.depth + k
            if k == level - 1:
                context = np.zeros(len(pairs), np.int64)
                context[pair] = of
                kinds = np.bincount(context, said & 1, len(contexts)).astype(np.int64)
                train = self.train[at]
                x = at[train]
                more = np.bincount(of[train], np.log(n[x] / seen[x]) - np.log(self.p[x]), len(contexts))
                out.append(self.requests(slot, contexts, kinds, np.round(more * FINE).astype(np.int64)))
                continue
            sums = self.answers(slot)
            kinds = (sums >> 1)[of]
            p = (n[at] + kinds * self.p[at]) / (seen[at] + kinds)
            self.p[at] = p
            self.levels.append((at, contexts, of, (sums & 1).astype(bool), p))
        if not send:
            return None
        if level > self.depth + 1:
            held = np.zeros(len(self.h), bool)  # a state's suffix is a state
            for k, (at, contexts, of, passes, _) in reversed(list(enumerate(self.levels, 1))):
                held[at] |= passes[of]
                if k < self.depth:  # only of contexts that do not diverge by themselves
                    out.append(self.requests(2 * self.depth + k, contexts[~passes], (np.bincount(of, held[at], len(contexts)) > 0)[~passes]))
        return pa.concat_tables(out) if out else self.requests(1, np.zeros(0, U), np.zeros(0, np.int64))

    def score(self) -> np.ndarray:
        """log10 P(token | longest suffix of its history that is a state)."""
        self.ask(self.depth + 2, send=False)
        p = self.root
        for k, (at, _, of, passes, deeper) in enumerate(self.levels, 1):
            if k < self.depth:
                passes[~passes] = self.answers(2 * self.depth + k) > 0
            state = passes[of]
            p[at[state]] = deeper[state]
        return np.log10(p)


def _reduce(buckets: int, depth: int, cost: float):
    """What a bucket answers: for words their counts, and rows of chunk -1 with its (tokens, distinct words); for pairs
    2n + 1 to the first chunk with the pair in training and 2n to others; for contexts twice the number of different next
    tokens, plus one if they diverge from the suffix; for states whether one says so."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")  # who is first does not depend on the order of arrival
        slot = table.column("bucket")[0].as_py() // buckets
        sums = depth < slot <= 2 * depth
        keys, vals, sizes = chunks.opened(table, 2 if sums else 1)
        found, at = chunks.distinct(keys)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, at, vals[0])
        if sums:
            more = np.zeros(len(found), np.int64)
            np.add.at(more, at, vals[1])
            total = 2 * total + (more > cost * FINE * total)
        if slot > 2 * depth:
            total = np.minimum(total, 1)
        reply = total[at]
        if 0 < slot <= depth:
            there = np.flatnonzero(vals[0])
            reply = 2 * reply
            reply[there[np.unique(at[there], return_index=True)[1]]] += 1
        out = chunks.replies(table, reply, sizes)
        if slot == 0:
            head = chunks.packed(np.array([total.sum(), (total > 0).sum()]))
            out = pa.concat_tables([out, pa.table({"chunk": pa.array([-1]), "bucket": table.column("bucket").slice(0, 1), "vals": pa.array([head], pa.binary())})])
        return out

    return run


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, least: int = 2, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Learns from the rows where ``held_out`` is not true. Null texts are empty and score their end; rows with equal ids
    are documents of their own. Without training tokens every token has probability one. Contexts have up to ``depth``
    words and stand ``least`` times or more in the training part. Only the id and the text column are read, and those of
    ``held_out``.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[id_col]
    docs, number = chunks.stored(df, id_col, text_col, held_out, tokens, chunk_bytes)
    buckets = max(1, number // 4)
    paths: list[str] = []

    def reply() -> DataFrame:
        return spark.read.schema(chunks.REPLY).parquet(*paths).where("chunk >= 0")

    def ask(requests: DataFrame, cost: float = 0.0) -> None:
        """One round: its replies are written."""
        path = work_path(spark, "replies")
        requests.groupBy("bucket").applyInArrow(_reduce(buckets, depth, cost), chunks.REPLY).write.option("compression", "none").parquet(path)
        paths.append(path)

    def words(mine: pa.Table) -> pa.Table:
        return Walk(mine, None, buckets, depth, least, 1.0).ask_words()

    ask(docs.groupBy("chunk").applyInArrow(words, chunks.REQUEST))
    chunks.release(spark)
    heads = spark.read.schema(chunks.REPLY).parquet(paths[0]).where("chunk = -1").select("vals")

    def sums(batches):
        for batch in batches:
            x = np.array([chunks.unpacked(b) for b in batch.column(0).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["n", "v"])

    n, v = (int(x or 0) for x in heads.mapInArrow(sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first())
    size = n + 0.5 * (v + 1)

    def answered(use, schema: str) -> DataFrame:
        def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
            return use(Walk(mine, theirs, buckets, depth, least, size))

        return docs.groupBy("chunk").cogroup(reply().groupBy("chunk")).applyInArrow(run, schema)

    for level in range(1, depth + (3 if depth > 1 else 2)) if n else ():
        ask(answered(lambda walk, level=level: walk.ask(level), chunks.REQUEST), PENALTY * float(np.log(max(n, 2))))
        chunks.release(spark)

    def use(walk: Walk) -> pa.Table:
        rows, doc = len(walk.ids), walk.doc
        base = np.log10(walk.root)
        full = walk.score() if n else base
        return pa.table(
            {
                "id": walk.ids,
                "held_out": walk.held,
                "n_tokens": pa.array(np.bincount(doc, minlength=rows)),
                "n_known": pa.array(np.bincount(doc[walk.count > 0], minlength=rows)),
                "train_tokens": pa.array(np.full(rows, n)),
                "base_score": pa.array(np.bincount(doc, base, minlength=rows)),
                "score": pa.array(np.bincount(doc, full, minlength=rows)),
            }
        )

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return answered(use, schema).withColumnRenamed("id", id_col)
