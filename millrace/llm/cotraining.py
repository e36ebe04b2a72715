"""A quality classifier of two views that teach each other.

One view sees a document's content: its words and their shapes. The other sees what is known about the page: language,
source, length and layout. Both are logistic regressions over hashed features. They begin with the labelled documents;
in each round either labels the unlabelled documents it is surest of for the other. Scores of both views are calibrated
on labelled documents that neither was trained on, where the weights are found too by which both views' odds are
combined to score every document.

Features are made once and written down. All else is sums over them, made in tasks: counts of features by class, from
which both views begin, gradients of everything taught, and how many of all unlabelled documents have which odds. The
last give the exact threshold from which on a share of all unlabelled documents is taught, so every document may teach.
The driver gets two numbers a feature and view, and the odds of the calibrating documents. Sums are of whole numbers, so
they do not depend on their order.

MOST_LABELLED labelled documents, which a hash of the identifier chooses, are looked at; it is the only sample. Rows with
a labelled identifier count once as labelled. Null texts count as empty, null metadata as a value of its own. A label of
null is no label. Without labels of both kinds every document gets the share of good labels, 1 without any.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Stored, discard, stored

MOST_LABELLED = 8000
SIZE = 1 << 16  # of either view's hashed features
ROUNDS = 4
SURE = 0.97
MOST_TAUGHT = 0.1  # of the unlabelled documents, by either view, more with each round
CALIBRATION = 5  # every fifth labelled document calibrates
STEPS = 5  # of either view in a round
RIDGE = 0.1
DECAY = 1e-4
SMOOTH = 0.5
ODDS = 256  # steps of log odds, within ODDS_RANGE
ODDS_RANGE = 30
WHOLE = 2.0**52  # a sum of 1 as a whole number
REDUCERS = 16
SEED = "co-training"

# Letters to a and A, digits to 0; runs of a are made short by splitting there.
SHAPES = bytes.maketrans(
    bytes(range(97, 123)) + bytes(range(65, 91)) + bytes(range(48, 58)) + bytes(range(128, 256)),
    b"a" * 26 + b"A" * 26 + b"0" * 10 + b"a" * 128,
)


def _hashed(values: dict[bytes, float], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and weights of unit length."""
    columns = np.fromiter((xxhash.xxh3_64_intdigest(v, salt) % SIZE for v in values), np.int32, len(values))
    weights = np.fromiter(values.values(), np.float32, len(values))
    return columns, weights / np.sqrt(max(1e-9, float(weights @ weights)))


def content_view(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = text.encode()
    found = {b"w" + w: 1 + math.log(n) for w, n in Counter(raw.lower().split()).items()}
    shapes: dict[bytes, int] = {}
    total = 0
    for shape, n in Counter(raw.translate(SHAPES).split()).items():
        # A shape keeps its marks and the kinds of its letters, not their number.
        short = bytes(c for i, c in enumerate(shape[:24]) if i == 0 or c != shape[i - 1] or c not in b"aA0")
        shapes[short] = shapes.get(short, 0) + n
        total += n
    scale = 4 * math.sqrt(sum(v * v for v in found.values()) or 1.0)
    found |= {b"s" + s: scale * n / total for s, n in shapes.items()}
    return _hashed(found or {b"none": 1.0}, 1)


def metadata_view(text: str, lang: str | None, source: str | None) -> tuple[np.ndarray, np.ndarray]:
    lines = text.split("\n")
    step = lambda x: b"%d" % round(2 * math.log2(1 + x))
    values = {
        "lang": (lang or "\0").encode(),
        "source": (source or "\0").encode(),
        "chars": step(len(text)),
        "lines": step(len(lines)),
        "line": step(len(text) / len(lines)),
        "longest": step(max(map(len, lines))),
        "again": b"%d" % round(10 * (1 - len(set(lines)) / len(lines))),
        "ends": b"%d" % round(10 * sum(x[-1:] in ".!?" and x != "" for x in lines) / len(lines)),
    }
    return _hashed({k.encode() + b"=" + v: 1.0 for k, v in values.items()}, 2)


class Rows:
    """Sparse rows as flat columns and weights."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.columns = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.int32)
        self.weights = np.concatenate([r[1] for r in rows]) if rows else np.empty(0, np.float32)
        self.row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        self.n = len(rows)

    def take(self, chosen: np.ndarray) -> Rows:
        """The rows numbered by `chosen`, in order."""
        new = np.full(self.n, -1)
        new[chosen] = np.arange(len(chosen))
        inside = new[self.row] >= 0
        out = Rows([])
        out.columns, out.weights, out.row, out.n = self.columns[inside], self.weights[inside], new[self.row[inside]], len(chosen)
        return out

    def dot(self, model: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.weights * model[self.columns], self.n) + model[-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def calibration(scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """A slope for each row of `scores` and a constant: Platt's sigmoid, by Newton's method on smoothed labels."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.vstack([scores, np.ones(scores.shape[1])]).T
    at = begun = np.append(np.full(len(scores), 1 / len(scores)), 0.0)
    for _ in range(30):
        p = sigmoid(x @ at)
        slope = x.T @ (p - target) + RIDGE * (at - begun)
        curve = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(at))
        at = at - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return np.append(np.maximum(at[:-1], 0.0), at[-1])


class Batch:
    """Some documents: their rows in both views; what each view is to learn of them (1, 0, or -1 for nothing); whether that
    was taught by the other view; labels, and whether they calibrate."""

    def __init__(self, views: list[Rows], learn: np.ndarray, taught: np.ndarray, label: np.ndarray, held: np.ndarray) -> None:
        self.views, self.learn, self.taught, self.label, self.held = views, learn, taught, label, held

    @staticmethod
    def begun(views: list[Rows], label: np.ndarray, held: np.ndarray) -> Batch:
        learn = np.where(held, -1, label).astype(np.int64)
        return Batch(views, np.stack([learn, learn]), np.zeros((2, len(label)), bool), label.astype(np.int64), held)

    def odds(self, models: list[np.ndarray]) -> np.ndarray:
        return np.stack([rows.dot(m) for rows, m in zip(self.views, models)])


def class_sums(batch: Batch) -> np.ndarray:
    """Weights of features by view and class, and the numbers of labelled documents: trained good and bad, held likewise."""
    out = []
    for rows, learn in zip(batch.views, batch.learn):
        for kind in (1, 0):
            out.append(np.bincount(rows.columns, rows.weights * (learn == kind)[rows.row], SIZE) * 2**20)
    numbers = [((batch.label == k) & (batch.held == h)).sum() for h in (False, True) for k in (1, 0)]
    return np.concatenate([*out, numbers]).round().astype(np.int64)


def slopes(batch: Batch, models: list[np.ndarray], each: np.ndarray) -> np.ndarray:
    """Gradients of both views. `each`: by view, label and whether it was taught, the weight of a document."""
    out = []
    for v, rows in enumerate(batch.views):
        learn = batch.learn[v]
        weight = np.where(learn >= 0, each[v, np.maximum(learn, 0), batch.taught[v].astype(np.int64)], 0.0)
        error = (sigmoid(rows.dot(models[v])) - (learn == 1)) * weight
        out += [np.bincount(rows.columns, rows.weights * error[rows.row], SIZE), [error.sum()]]
    return (np.concatenate(out) * WHOLE).round().astype(np.int64)


def steps_of(odds: np.ndarray) -> np.ndarray:
    return (np.clip(odds, -ODDS_RANGE, ODDS_RANGE) * ODDS).round().astype(np.int64)


def odds_counts(batch: Batch, models: list[np.ndarray], scales: list[np.ndarray]) -> np.ndarray:
    """How many unlabelled documents have which odds, by view."""
    free = batch.label < 0
    size = 2 * ODDS_RANGE * ODDS + 1
    calibrated = [steps_of(a * x + b)[free] for x, (a, b) in zip(batch.odds(models), scales)]
    return np.concatenate([np.bincount(x + ODDS_RANGE * ODDS, minlength=size) for x in calibrated])


def taught_marks(batch: Batch, models: list[np.ndarray], scales: list[np.ndarray], bounds: list[tuple[int, int]]) -> Batch:
    """Unlabelled documents with what either view teaches the other: odds up to a lower bound are bad, from an upper on good."""
    learn = np.full(batch.learn.shape, -1)
    for v, (x, (a, b), (bad, good)) in enumerate(zip(batch.odds(models), scales, bounds)):
        at = steps_of(a * x + b)
        learn[1 - v] = np.where(batch.label >= 0, -1, np.where(at >= good, 1, np.where(at <= bad, 0, -1)))
    return Batch(batch.views, learn, learn >= 0, batch.label, batch.held)


def bounds_of(counts: np.ndarray, room: float, share: float) -> tuple[tuple[int, int], int, int]:
    """The odds from which on documents are taught as bad and as good, and how many of them there are.

    As many of either kind as there are among the labelled, `room` in all, but only sure ones and never a part of a tie.
    """
    middle = ODDS_RANGE * ODDS
    sure = math.ceil(math.log(SURE / (1 - SURE)) * ODDS)
    from_top, from_bottom = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    good = max(sure, int(np.argmax(from_top <= room * share)) - middle if (from_top <= room * share).any() else middle + 1)
    fits = np.flatnonzero(from_bottom <= room * (1 - share))
    bad = min(-sure, int(fits[-1]) - middle if len(fits) else -middle - 1)
    n_good = int(from_top[good + middle]) if good <= middle else 0
    n_bad = int(from_bottom[bad + middle]) if bad >= -middle else 0
    return (bad, good), n_good, n_bad


class Local:
    """Documents in memory, with the interface of Spread."""

    def __init__(self, batches: list[Batch]) -> None:
        self.batches = batches

    def total(self, of: Callable[[Batch], np.ndarray], size: int) -> np.ndarray:
        return sum((of(b) for b in self.batches), np.zeros(size, np.int64))

    def marked(self, by: Callable[[Batch], Batch], more: Local) -> Local:
        return Local([by(b) for b in self.batches] + more.batches)

    def held_odds(self, models: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([b.odds(models)[:, b.held] for b in self.batches], axis=1), np.concatenate([b.label[b.held] for b in self.batches])

    def gone(self) -> None:
        pass


def cotrain(all_: Local | Spread, labelled: Local | Spread, n_free: int, rounds: int = ROUNDS) -> dict | None:
    """The model from all documents and the labelled ones. None without both kinds of labels, in training and calibration."""
    sums = labelled.total(class_sums, 4 * SIZE + 4)
    numbers = sums[4 * SIZE :]
    if not numbers.all():
        return None
    n_train, share = int(numbers[:2].sum()), float(numbers[0] / numbers[:2].sum())
    # Both views begin with the log ratios of their features' shares among good and bad documents.
    shares = sums[: 4 * SIZE].reshape(2, 2, SIZE) / 2**20 + SMOOTH
    begun = np.log(shares / shares.sum(axis=2, keepdims=True))
    models = [np.append(good - bad, 0.0) for good, bad in begun]
    odds, labels = labelled.held_odds(models)
    for model, x in zip(models, odds):
        slope, constant = calibration(x[None, :], labels)
        model *= slope
        model[-1] += constant
    squares = [np.full(SIZE + 1, 1e-8) for _ in models]
    known, taught = labelled, np.zeros((2, 2))  # documents taught, by view and label
    for turn in range(rounds + 1):
        # Classes weigh alike, and what was taught no more than what was labelled.
        each = np.zeros((2, 2, 2))
        for v in range(2):
            part = min(1.0, n_train / max(1.0, taught[v].sum()))
            for kind in range(2):
                mass = numbers[1 - kind] + part * taught[v, kind]
                each[v, kind] = [0.5 / mass, 0.5 * part / mass]
        for _ in range(STEPS):
            found = known.total(partial(slopes, models=models, each=each), 2 * (SIZE + 1)).reshape(2, SIZE + 1) / WHOLE
            for v in range(2):
                slope = found[v] + DECAY * models[v]
                squares[v] += slope * slope
                models[v] = models[v] - 0.5 * slope / np.sqrt(squares[v])
        odds, labels = labelled.held_odds(models)
        scales = [calibration(x[None, :], labels) for x in odds]
        if known is not labelled:
            known.gone()
        if turn == rounds or not n_free:
            break
        counts = all_.total(partial(odds_counts, models=models, scales=scales), 2 * (2 * ODDS_RANGE * ODDS + 1)).reshape(2, -1)
        room = MOST_TAUGHT * (turn + 1) * n_free
        bounds = []
        for v in range(2):
            own, n_good, n_bad = bounds_of(counts[v], room, share)
            bounds.append(own)
            taught[1 - v] = n_bad, n_good
        if not taught.any():
            break
        known = all_.marked(partial(taught_marks, models=models, scales=scales, bounds=bounds), labelled)
    both = calibration(np.stack([a * x + b for x, (a, b) in zip(odds, scales)]), labels)
    return {"models": [m.astype(np.float32) for m in models], "scales": scales, "both": both}


def combined(model: dict, views: list[Rows]) -> np.ndarray:
    """The probability that a document is good."""
    odds = np.stack([a * rows.dot(m) + b for rows, m, (a, b) in zip(views, model["models"], model["scales"])])
    return sigmoid(model["both"][:-1] @ odds + model["both"][-1])


def both_views(texts: list, langs: list, sources: list) -> list[Rows]:
    return [
        Rows([content_view(t or "") for t in texts]),
        Rows([metadata_view(t or "", lang, source) for t, lang, source in zip(texts, langs, sources)]),
    ]


FEATURES_SQL = "id bigint, label int, held boolean, learn0 int, learn1 int, c0 binary, w0 binary, c1 binary, w1 binary"
FEATURES = pa.schema([
    ("id", pa.int64()), ("label", pa.int32()), ("held", pa.bool_()), ("learn0", pa.int32()), ("learn1", pa.int32()),
    *[(n, pa.binary()) for n in ("c0", "w0", "c1", "w1")],
])
TEXTS = 1000  # at a time


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns as 16-bit numbers and weights as 16-bit floats, once for all passes."""
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS):
            batch = whole.slice(at, TEXTS)
            texts, langs, sources = (batch.column(n).to_pylist() for n in ("text", "lang", "source"))
            packed: list[list[bytes]] = [[], [], [], []]
            for text, lang, source in zip(texts, langs, sources):
                for v, (columns, weights) in enumerate((content_view(text or ""), metadata_view(text or "", lang, source))):
                    packed[2 * v].append(columns.astype(np.uint16).tobytes())
                    packed[2 * v + 1].append(weights.astype(np.float16).tobytes())
            none = pa.array([-1] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("held"), none, none, *[pa.array(p, pa.binary()) for p in packed]], schema=FEATURES
            )


def _unpacked(batch: pa.RecordBatch) -> Batch:
    views = []
    for v in "01":
        columns, weights = batch.column(f"c{v}").to_pylist(), batch.column(f"w{v}").to_pylist()
        rows = Rows([])
        rows.columns = np.frombuffer(b"".join(columns), np.uint16).astype(np.int32)
        rows.weights = np.frombuffer(b"".join(weights), np.float16).astype(np.float32)
        rows.row = np.repeat(np.arange(batch.num_rows), [len(c) // 2 for c in columns])
        rows.n = batch.num_rows
        views.append(rows)
    label, held = batch.column("label").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
    begun = Batch.begun(views, label, held)
    learn = np.stack([batch.column(f"learn{v}").to_numpy() for v in "01"]).astype(np.int64)
    begun.taught = learn >= 0
    begun.learn = np.where(begun.taught, learn, begun.learn)
    return begun


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS):
            yield whole.slice(at, TEXTS)


class Spread:
    """Documents' features in a written table."""

    def __init__(self, df: DataFrame, own: Stored | None = None) -> None:
        self.df, self.own = df, own

    def total(self, of: Callable[[Batch], np.ndarray], size: int) -> np.ndarray:
        """Sums over all documents; a task hands on one array in REDUCERS parts, and each part's sum comes to the driver."""
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, np.int64)
            for batch in _parts(batches):
                total += of(_unpacked(batch))
            yield handed_on(dict(enumerate(np.array_split(total, REDUCERS))))

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                for i, part in enumerate(batch.column("part").to_pylist()):
                    own = np.frombuffer(batch.column("sums")[i].as_py(), np.int64)
                    totals[part] = totals[part] + own if part in totals else own
            yield handed_on(totals)

        def handed_on(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
            sums = pa.array([x.tobytes() for x in parts.values()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), sums], names=["part", "sums"])

        columns = "part int, sums binary"
        found = dict(self.df.mapInArrow(summed, columns).repartition("part").mapInArrow(added, columns).collect())
        parts = np.array_split(np.zeros(size, np.int64), REDUCERS)
        return np.concatenate([np.frombuffer(found[i], np.int64) if i in found else x for i, x in enumerate(parts)])

    def marked(self, by: Callable[[Batch], Batch], more: Spread) -> Spread:
        """Those that `by` marks, written down, and `more`."""
        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                learn = by(_unpacked(batch)).learn.astype(np.int32)
                columns = [batch.column(n) if not n.startswith("learn") else pa.array(learn[int(n[-1])]) for n in FEATURES.names]
                yield pa.RecordBatch.from_arrays(columns, schema=FEATURES).filter(pa.array((learn >= 0).any(axis=0)))

        own = stored(self.df.mapInArrow(chosen, FEATURES_SQL), "taught")
        return Spread(own.df.union(more.df), own)

    def held_odds(self, models: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                own = _unpacked(batch)
                x = own.odds(models)[:, own.held]
                yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1]), pa.array(own.label[own.held])], names=["a", "b", "label"])

        rows = self.df.where("held").mapInArrow(odds, "a double, b double, label bigint").toArrow().sort_by([("a", "ascending"), ("b", "ascending")])
        return np.stack([rows["a"].to_numpy(), rows["b"].to_numpy()]), rows["label"].to_numpy()

    def gone(self) -> None:
        if self.own:
            discard(self.df.sparkSession, self.own)


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(combined(model.value, _unpacked(batch).views))], names=["id", "score"])


def _sample(ids: DataFrame, most: int) -> DataFrame:
    return ids.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(most)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    label_col: str = "quality",
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """Rows (id, score) of every row of `docs`."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
    )
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label")
    )
    # An identifier with several labels counts with the lowest. Only labels of documents that are there are drawn.
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    here = texts.select("id").where("id is not null").distinct()
    drawn = sorted(tuple(r) for r in _sample(known.join(here, "id", "left_semi"), most_labelled).collect())
    if len({label for _, label in drawn}) < 2:
        share = sum(label for _, label in drawn) / len(drawn) if drawn else 1.0
        return texts.select("id", F.lit(float(share)).alias("score"))
    # Bounded by the parameter, and so may be broadcast.
    marks = [(own, label, i % CALIBRATION == 0) for i, (own, label) in enumerate(drawn)]
    marks = F.broadcast(spark.createDataFrame(marks, "id bigint, label int, held boolean"))
    labelled = texts.join(marks, "id", "left").select(
        "id", "text", "lang", "source", F.coalesce("label", F.lit(-1)).alias("label"), F.coalesce("held", F.lit(False)).alias("held")
    )
    features = stored(labelled.mapInArrow(_featured, FEATURES_SQL), "features").df
    # Of rows that share a labelled identifier one counts, whichever comes first by its features.
    own = F.struct(*FEATURES.names[1:])
    once = stored(
        features.where("label >= 0").groupBy("id").agg(F.min_by(own, F.xxhash64("c0", "w0", "c1")).alias("own")).select("id", "own.*"), "labelled"
    ).df
    model = cotrain(Spread(features), Spread(once), features.where("label < 0").count())
    if model is None:
        return texts.select("id", F.lit(sum(label for _, label in drawn) / len(drawn)).alias("score"))
    return features.mapInArrow(partial(_scored, model=spark.sparkContext.broadcast(model)), "id bigint, score double")
