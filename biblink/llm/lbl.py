"""LM scoring with a log-bilinear neural model trained by noise-contrastive estimation.

1. Tokens of the training texts are counted (per task, then summed), which
   gives the base (add-half unigram) model and the vocabulary.
2. The ``cached`` most frequent tokens have embeddings of their own.  The
   probability of a token is that of its class times its own in the class: the
   most frequent tokens are classes by themselves, the others are dealt, by
   count, to classes of about equal mass of square roots of counts, and all
   rarer tokens are one rest class.
   Both factors are log-bilinear: the embeddings of the ``CONTEXT`` classes
   (for the factor within a class: tokens) before a token, each times a position
   matrix, add up to a predicted embedding; its product with an output embedding
   plus a bias is the score.  Both are trained in numpy by noise-contrastive
   estimation, with noise from all classes or from the members of the class.
3. Training goes in ``ROUNDS`` rounds over disjoint parts of the training
   texts.  In a round every shard of about ``SHARD`` tokens starts from the same
   parameters; the results are averaged, each row of an embedding by the number
   of its examples, and start the next round.  Rounds and shards are hashes of
   key and text, and a shard is read in an order of its own, so the model depends on
   the texts and not on how they are partitioned.  Its updates grow with them.
4. A batch of texts is scored by matrix products, normalised over all classes
   and over the members of a class.  A token of the rest class has its class
   probability times its add-half share of that class, where everything
   unseen counts as one more token; so probabilities of the next token sum
   to one over the known tokens and "unseen".

The texts are written once as token numbers, which all rounds and the scoring read.

Counts of the ``cached`` most frequent tokens (a parameter) are broadcast;
rarer tokens are looked up by a join on the token.

Nulls: a null text is empty: it has the end token only; a null key is hashed
as the empty string.  Repeated rows count and are scored each on their own.
Without training texts all counts are zero and the start parameters score.
A text of any length is scored whole; its numbers are held in one task.
Empty tables give empty results.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Ends every text; no word holds a line feed.
END = "\n"
CLASSES, CACHED, CONTEXT, WIDTH = 512, 100_000, 2, 16
BATCH, NOISE, RATE = 4096, 32, 0.15
ROUNDS, SHARD = 3, 1 << 22
#: Training within classes: tokens a step, noise tokens a class and step, rate.
STEP, MEMBERS, WITHIN_RATE = 1 << 14, 24, 0.1
#: Rows of an embedding that are averaged together, and shards averaged in one task.
BLOCK, FAN_IN = 8192, 64
#: Distinct tokens that a task counts before it hands them on.
HELD = 300_000


def tokens(text: str | None) -> list[str]:
    """A-Z lower-cased words between ASCII white space, then one end token."""
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


def is_training(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 != 1


def count_tokens(training: DataFrame) -> DataFrame:
    """``token, c`` over all texts of ``training(text)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update(tokens(text))
                if len(held) > HELD:
                    yield pd.DataFrame({"token": list(held), "n": list(held.values())})
                    held.clear()
        yield pd.DataFrame({"token": pd.Series(list(held), dtype=object), "n": pd.Series(list(held.values()), dtype="int64")})

    return training.mapInPandas(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, cached: int) -> list:
    """The most frequent tokens, by count and token: at most ``cached``, cut where a
    power of 2 ** (1/64) divides the counts, so no sort and no tie is needed."""
    step = F.floor(F.log2("c") * 64)
    sizes = sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True)  # under 64 x 64 rows
    low, n = None, 0
    for s, size in sizes:
        if n + size > cached:
            break
        low, n = s, n + size
    rows = counts.where(step >= low).collect() if low is not None else []
    return sorted(rows, key=lambda r: (-r["c"], r["token"]))


class Model:
    """Parameters of the log-bilinear model as one flat vector.

    ``inputs`` (classes + 1 for "before the text") and ``outputs`` are embeddings,
    ``mix`` holds one matrix per context position, ``bias`` one number per class."""

    def __init__(self, classes: int, flat: np.ndarray | None = None, share: np.ndarray | None = None):
        sizes = [(classes + 1) * WIDTH, classes * WIDTH, CONTEXT * WIDTH * WIDTH, classes]
        if flat is None:
            rng = np.random.default_rng(8)
            flat = rng.normal(0, 0.1, sum(sizes)).astype(np.float32)
            flat[-classes:] = np.log(share)
        self.flat, self.classes = flat.astype(np.float32), classes
        a, b, c, d = np.split(self.flat, np.cumsum(sizes)[:-1])
        self.inputs, self.outputs, self.mix, self.bias = a.reshape(-1, WIDTH), b.reshape(-1, WIDTH), c.reshape(CONTEXT, WIDTH, WIDTH), d

    def predict(self, context: np.ndarray) -> np.ndarray:
        """Predicted embeddings of contexts (rows of class numbers, nearest first)."""
        return sum(self.inputs[context[:, j]] @ self.mix[j] for j in range(CONTEXT))

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of P(target | context), normalised over all classes; every
        distinct context is predicted and normalised once."""
        base = self.classes + 1
        code = context[:, 0].astype(np.int64)
        for j in range(1, CONTEXT):
            code = code * base + context[:, j]
        _, first, back = np.unique(code, return_index=True, return_inverse=True)
        out = np.empty(len(target), np.float64)
        order = np.argsort(back, kind="stable")
        edges = np.concatenate(([0], np.cumsum(np.bincount(back, minlength=len(first)))))
        for lo in range(0, len(first), BATCH):
            hi = min(lo + BATCH, len(first))
            score = self.predict(context[first[lo:hi]]) @ self.outputs.T + self.bias
            score -= score.max(axis=1, keepdims=True)
            norm = np.log(np.exp(score).sum(axis=1, dtype=np.float64))
            rows = order[edges[lo] : edges[hi]]
            local = back[rows] - lo
            out[rows] = score[local, target[rows]] - norm[local]
        return out

    def train(self, context: np.ndarray, target: np.ndarray, share: np.ndarray, rng: np.random.Generator, memory: np.ndarray) -> None:
        """One pass of NCE over the examples, Adagrad; ``memory`` holds squared gradients."""
        log_noise = np.log(share * NOISE).astype(np.float32)
        grad_flat = np.zeros_like(self.flat)
        grad = Model(self.classes, grad_flat)
        grad_flat = grad.flat
        for lo in range(0, len(target), BATCH):
            ctx, want = context[lo : lo + BATCH], target[lo : lo + BATCH]
            noise = rng.choice(self.classes, NOISE, p=share)
            q = self.predict(ctx)
            up = 1 - _sigmoid((q * self.outputs[want]).sum(1) + self.bias[want] - log_noise[want])
            down = -_sigmoid(q @ self.outputs[noise].T + self.bias[noise] - log_noise[noise])
            dq = up[:, None] * self.outputs[want] + down @ self.outputs[noise]
            grad_flat[:] = 0
            _scatter(grad.outputs, want, up[:, None] * q)
            np.add.at(grad.outputs, noise, down.T @ q)
            grad.bias += np.bincount(want, up, self.classes).astype(np.float32)
            np.add.at(grad.bias, noise, down.sum(0))
            for j in range(CONTEXT):
                x = self.inputs[ctx[:, j]]
                grad.mix[j] += x.T @ dq
                _scatter(grad.inputs, ctx[:, j], dq @ self.mix[j].T)
            grad_flat /= len(want)
            memory += grad_flat**2
            self.flat += RATE * grad_flat / np.sqrt(memory + 1e-6)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scatter(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add ``values`` to rows of ``into`` that may repeat."""
    for k in range(into.shape[1]):
        into[:, k] += np.bincount(rows, values[:, k], len(into)).astype(np.float32)


def contexts(ids: list[np.ndarray], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Context classes (nearest first; ``classes`` stands before a text) and targets of some texts."""
    target = np.concatenate(ids) if ids else np.empty(0, np.int32)
    context = np.full((len(target), CONTEXT), classes, np.int32)
    place = np.concatenate([np.arange(len(x)) for x in ids]) if ids else target
    for j in range(CONTEXT):
        inside = np.flatnonzero(place > j)
        context[inside, j] = target[inside - j - 1]
    return context, target


class Within:
    """The factor within classes: ``inputs`` (tokens, "rest", "before the text") and ``outputs`` are
    embeddings, ``mix`` holds one matrix per context position, ``bias`` one number per token.
    Tokens are ranks; class c holds the ranks from ``low[c]`` to ``low[c + 1]`` - 1."""

    def __init__(self, counts: np.ndarray, low: np.ndarray):
        n, self.low = len(counts), low
        rng = np.random.default_rng(88)
        self.inputs = rng.normal(0, 0.1, (n + 2, WIDTH)).astype(np.float32)
        self.mix = np.tile(np.eye(WIDTH, dtype=np.float32), (CONTEXT, 1, 1)) + rng.normal(0, 0.05, (CONTEXT, WIDTH, WIDTH)).astype(np.float32)
        self.outputs = np.zeros((n, WIDTH), np.float32)
        self.total = np.concatenate(([0.0], np.cumsum(counts, dtype=np.float64)))
        kind = np.searchsorted(low, np.arange(n), side="right") - 1
        self.share = np.log(counts / (self.total[low[kind + 1]] - self.total[low[kind]])).astype(np.float32) if n else np.empty(0, np.float32)
        self.bias = self.share[:, None].copy()

    def arrays(self) -> list[np.ndarray]:
        """What training changes; ``mix`` as rows, like the others."""
        return [self.inputs, self.outputs, self.bias, self.mix.reshape(CONTEXT, -1)]

    def predict(self, context: np.ndarray) -> np.ndarray:
        return sum(self.inputs[context[:, j]] @ self.mix[j] for j in range(CONTEXT))

    def members(self, target: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
        """Places in ``target`` by class, for classes with several tokens, with the ranks of the class."""
        kind = np.searchsorted(self.low, target, side="right") - 1
        order = np.argsort(kind, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
            if len(rows):
                lo, hi = int(self.low[kind[rows[0]]]), int(self.low[kind[rows[0]] + 1])
                if hi - lo > 1:
                    yield rows, lo, hi

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of P(target | its class, context); targets are ranks."""
        out = np.zeros(len(target), np.float64)
        for rows, lo, hi in self.members(target):
            step = max(1, (1 << 22) // (hi - lo))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                score = self.predict(context[part]) @ self.outputs[lo:hi].T + self.bias[lo:hi, 0]
                score -= score.max(axis=1, keepdims=True)
                out[part] = score[np.arange(len(part)), target[part] - lo] - np.log(np.exp(score).sum(axis=1, dtype=np.float64))
        return out

    def train(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator, memory: list[np.ndarray], seen: list[np.ndarray]) -> None:
        """One step of NCE in every class; ``memory`` holds mean squared gradients of rows, ``seen`` their examples."""
        groups = list(self.members(target))
        if not groups:
            return
        order = np.concatenate([rows for rows, _, _ in groups])
        context, want = context[order], target[order]
        q = self.predict(context)
        out, log_noise = self.outputs[want], np.float32(np.log(MEMBERS))
        up = 1 - _sigmoid((q * out).sum(1) + self.bias[want, 0] - self.share[want] - log_noise)
        dq = up[:, None] * out
        lo, hi = (np.array([g[i] for g in groups]) for i in (1, 2))
        drawn = rng.uniform(self.total[lo], self.total[hi], (MEMBERS, len(groups))).T
        noise = np.clip(np.searchsorted(self.total, drawn, side="right") - 1, lo[:, None], hi[:, None] - 1)
        embedded, offset = self.outputs[noise], self.bias[noise, 0] - self.share[noise] - log_noise
        noise_g = np.empty((len(groups), MEMBERS, WIDTH + 1), np.float32)
        at = 0
        for k, (rows, _, _) in enumerate(groups):  # a class sees only its own members
            mine = slice(at, at := at + len(rows))
            down = -_sigmoid(q[mine] @ embedded[k].T + offset[k])
            dq[mine] += down @ embedded[k]
            noise_g[k, :, :WIDTH] = down.T @ q[mine]
            noise_g[k, :, WIDTH] = down.sum(0)
        ids, g, n = _summed(np.concatenate((want, noise.ravel())), np.concatenate((np.column_stack((up[:, None] * q, up)), noise_g.reshape(-1, WIDTH + 1))))
        _adagrad(self.outputs, ids, g[:, :-1], memory[1])
        _adagrad(self.bias, ids, g[:, -1:], memory[2])
        seen[1][ids] += n
        seen[2][ids] += n
        ids = np.concatenate([context[:, j] for j in range(CONTEXT)])
        g = np.concatenate([dq @ self.mix[j].T for j in range(CONTEXT)])
        mixed = np.stack([self.inputs[context[:, j]].T @ dq for j in range(CONTEXT)])
        ids, g, n = _summed(ids, g)
        _adagrad(self.inputs, ids, g, memory[0])
        _adagrad(self.mix.reshape(CONTEXT, -1), np.arange(CONTEXT), mixed.reshape(CONTEXT, -1), memory[3])
        seen[0][ids] += n
        seen[3] += len(want)


def _summed(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, the sums of their rows and how many they were."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return ids[first], np.add.reduceat(rows[order], first, axis=0), np.diff(np.append(first, len(ids)))


def _adagrad(into: np.ndarray, ids: np.ndarray, g: np.ndarray, memory: np.ndarray) -> None:
    memory[ids] += (g**2).mean(axis=1)
    into[ids] += WITHIN_RATE * g / np.sqrt(memory[ids] + 1e-6)[:, None]


def class_borders(counts: np.ndarray, classes: int) -> np.ndarray:
    """First rank of every class, and the number of ranks: half of the classes but the rest are single
    tokens (all, if there are enough classes), the others have about equal sums of square roots of counts."""
    n, named = len(counts), classes - 1
    if n <= named:
        return np.minimum(np.arange(classes + 1), n)
    single = named // 2
    mass = np.cumsum(np.sqrt(counts[single:]))
    inner = single + np.searchsorted(mass, mass[-1] * np.arange(1, named - single) / (named - single))
    return np.concatenate((np.arange(single + 1), np.maximum.accumulate(inner), [n, n]))


_SUMS = "block int, shard bigint, sums binary, n binary"


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of one block over shards, in the order of the shards."""
    pdf = pdf.sort_values("shard")
    parts = [[np.frombuffer(x, np.float64) for x in pdf[c]] for c in ("sums", "n")]
    sums, n = (np.sum(x, axis=0) for x in parts)
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "shard": [int(pdf["shard"].iloc[0]) // FAN_IN], "sums": [sums.tobytes()], "n": [n.tobytes()]})


def fit(encoded: DataFrame, shared, share: np.ndarray, tokens_: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Parameters of both factors after all rounds.

    ``encoded`` has ``part, shard_key, ids`` of the training texts; ``shared`` is a broadcast (counts, class
    borders) of the cached tokens.  Starts one job a round; the driver holds the parameters."""
    classes, (counts, low) = len(share), shared.value
    spark = encoded.sparkSession
    model, within = Model(classes, None, share), Within(counts, low)
    shards = max(1, -(-tokens_ // (ROUNDS * SHARD)))
    for part in range(ROUNDS):
        start = spark.sparkContext.broadcast((model.flat, within.arrays()))

        def run(batches: Iterator[pd.DataFrame], start=start) -> Iterator[pd.DataFrame]:
            counts, low = shared.value
            shard, held = None, 0
            for batch in batches:
                for its, text_ids in zip(batch["shard"], batch["ids"]):
                    if its != shard:
                        if shard is not None:
                            yield from done(shard, *state)
                        shard, held, state = its, 0, _start(start.value, counts, low, share, its)
                    state[-1].append(np.asarray(text_ids, np.int32))
                    held += len(text_ids)
                    if held >= STEP:
                        _learn(*state)
                        held = 0
            if shard is not None:
                yield from done(shard, *state)

        def done(shard, model, within, rng, memory, seen, ids):
            _learn(model, within, rng, memory, seen, ids)
            block = 0
            for values, n in zip([model.flat[None], *within.arrays()], seen):
                for lo in range(0, len(values), BLOCK):
                    weight = n[lo : lo + BLOCK].astype(np.float64)
                    if weight.any():
                        yield pd.DataFrame({"block": [block], "shard": [shard], "sums": [(values[lo : lo + BLOCK] * weight[:, None]).tobytes()], "n": [weight.tobytes()]})
                    block += 1

        mine = encoded.where(F.col("part") == part).select(F.pmod("shard_key", F.lit(shards)).alias("shard"), "shard_key", "ids")
        ordered = mine.repartition("shard").sortWithinPartitions("shard", "shard_key", "ids")
        sums = ordered.mapInPandas(run, _SUMS)
        level = shards
        while level > 1:
            sums = sums.groupBy("block", F.floor(F.col("shard") / FAN_IN)).applyInPandas(_add_up, _SUMS)
            level = -(-level // FAN_IN)
        got = {r["block"]: r for r in sums.collect()}
        block = 0
        for values in [model.flat[None], *within.arrays()]:
            for lo in range(0, len(values), BLOCK):
                if block in got:
                    n = np.frombuffer(got[block]["n"], np.float64)
                    rows = np.flatnonzero(n)
                    total = np.frombuffer(got[block]["sums"], np.float64).reshape(len(n), -1)
                    values[lo + rows] = (total[rows] / n[rows, None]).astype(np.float32)
                block += 1
        start.destroy()
    return model.flat, within.arrays()


def _start(parameters, counts, low, share, shard):
    flat, arrays = parameters
    model, within = Model(len(share), flat.copy()), Within(counts, low)
    within.inputs, within.outputs, within.bias = (x.copy() for x in arrays[:3])
    within.mix = arrays[3].reshape(within.mix.shape).copy()
    memory = [np.full(len(model.flat), 1e-4, np.float32), *(np.full(len(x), 1e-4, np.float32) for x in arrays)]
    seen = [np.zeros(1), *(np.zeros(len(x), np.int64) for x in arrays)]
    model.share = share
    return model, within, np.random.default_rng([80, int(shard)]), memory, seen, []


def _learn(model, within, rng, memory, seen, ids) -> None:
    """Train both factors on the texts held."""
    if not ids:
        return
    kinds = [kinds_of(x, within.low) for x in ids]
    model.train(*contexts(kinds, model.classes), model.share, rng, memory[0])
    n = len(within.bias)
    context, target = contexts(ids, n + 1)
    known = np.flatnonzero(target < n)
    for lo in range(0, len(known), STEP):
        rows = known[lo : lo + STEP]
        within.train(context[rows], target[rows], rng, memory[1:], seen[1:])
    seen[0] += len(target)
    ids.clear()


def kinds_of(ids: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Classes of ranks; ranks beyond the cached tokens are in the last one."""
    return np.minimum(np.searchsorted(low, ids, side="right") - 1, len(low) - 2).astype(np.int32)


def score(df: DataFrame, *, key: str = "doc_id", text: str = "text", classes: int = CLASSES, cached: int = CACHED) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), (~is_training(F.col(key))).alias("held_out"))
    training = docs.where("not held_out").select("text")
    counts = written(count_tokens(training), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = most_frequent(counts, cached)
    seen = np.array([r["c"] for r in head], np.float64)
    low = class_borders(seen, classes)
    # a class without tokens keeps a small noise share; the last one is the rest
    sums = np.concatenate(([0.0], np.cumsum(seen)))
    share = sums[low[1:]] - sums[low[:-1]] + 0.5
    share[-1] += total - seen.sum()
    share /= share.sum()
    missing = len(head)
    lookup = spark.sparkContext.broadcast({r["token"]: i for i, r in enumerate(head)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    encoded_type = f"doc_id {id_type}, held_out boolean, row bigint, part int, shard_key bigint, ids array<int>, rare array<string>, times array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = lookup.value
        for batch in batches:
            ids, rare = [], []
            for text in batch["text"].to_pylist():
                words = tokens(text)
                ids.append([rank.get(t, missing) for t in words])
                rare.append(Counter(t for t, i in zip(words, ids[-1], strict=True) if i == missing))
            yield pa.record_batch({
                **{c: batch[c] for c in ("doc_id", "held_out", "row", "part", "shard_key")}, "ids": pa.array(ids, pa.list_(pa.int32())),
                "rare": pa.array([list(x) for x in rare], pa.list_(pa.string())), "times": pa.array([list(x.values()) for x in rare], pa.list_(pa.int32())),
            })

    hashed = F.xxhash64(F.col("doc_id").cast("string"), "text")  # rows without a key spread by their texts
    keyed = docs.select("doc_id", "held_out", F.monotonically_increasing_id().alias("row"), F.pmod(hashed, F.lit(ROUNDS)).cast("int").alias("part"),
                        F.floor(F.abs(F.shiftright(hashed, 1)) / ROUNDS).cast("bigint").alias("shard_key"), "text")
    encoded = written(keyed.mapInArrow(encode, encoded_type), "encoded")
    shared = spark.sparkContext.broadcast((seen, low))
    fitted = spark.sparkContext.broadcast(fit(encoded.where("not held_out"), shared, share, int(total)))
    rest_mass = np.log10((total - seen.sum()) + 0.5 * (distinct - missing) + 0.5)
    parts_type = f"doc_id {id_type}, held_out boolean, row bigint, n_tokens bigint, n_known bigint, base double, model double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, low = shared.value
        flat, arrays = fitted.value
        model, within = Model(classes, flat), Within(c, low)
        within.inputs, within.outputs, within.bias, within.mix = *arrays[:3], arrays[3].reshape(within.mix.shape)
        log_c = np.concatenate((np.log10(c + 0.5), [0.0]))
        for batch in batches:
            lists, at = batch["ids"], 0
            edges = lists.offsets.to_numpy()
            while at < len(lists):  # groups of texts with a bounded number of tokens
                lo, at = at, max(at + 1, int(np.searchsorted(edges, edges[at] + 256 * BATCH)))
                at = min(at, len(lists))
                ids = [lists[i].values.to_numpy() for i in range(lo, at)]
                context, flat_ids = contexts(ids, missing + 1)
                cut = np.cumsum([0, *map(len, ids)])[:-1]
                kinds = [kinds_of(x, low) for x in ids]
                logs = model.log_probability(*contexts(kinds, classes))
                known = np.flatnonzero(flat_ids < missing)
                logs[known] += within.log_probability(context[known], flat_ids[known])
                logs /= np.log(10)
                # rare tokens get their counts after the join
                logs[flat_ids == missing] -= rest_mass
                yield pa.record_batch({
                    **{name: batch[name].slice(lo, at - lo) for name in ("doc_id", "held_out", "row")},
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "n_known": pa.array(np.add.reduceat((flat_ids != missing).astype(np.int64), cut)),
                    "base": pa.array(np.add.reduceat(log_c[flat_ids], cut)), "model": pa.array(np.add.reduceat(logs, cut)),
                })

    parts = written(encoded.select("doc_id", "held_out", "row", "ids").mapInArrow(run, parts_type), "parts")
    rare = encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("token"), F.col("r.times").alias("times"))
    looked = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known")
    ).withColumnRenamed("row", "r")
    norm = float(np.log10(total + 0.5 * (distinct + 1)))
    logs = F.coalesce("logs", F.lit(0.0))
    return parts.join(looked, F.col("row") == F.col("r"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("model") + logs).alias("score"),
    )
