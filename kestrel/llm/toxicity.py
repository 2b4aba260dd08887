"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.common import materialise, prepare_python, stored, whole_row, with_row_key

THRESHOLD = 0.7
# bounds of the labelled sample that voters and classifier are fitted on, by label
SAMPLE_TOXIC, SAMPLE_CLEAN = 2048, 4096
STEMS = (4, 5)  # word beginnings that can be lexicon entries
MIN_FIRES = 4  # documents of the sample that an entry must be in
MAX_CLEAN = 0.01  # share of clean documents among those of the sample that hold an entry
CHANCE = 0.01
ROUNDS = 50
MIN_CORRELATION = 0.15  # residual correlation from which voters are of one group
MIN_Z = 6.0
L1 = 2e-5
STEPS = 2000
CACHED_WORDS = 200_000

# fixed values: patterns of insult, threat and shouting that vote besides the lexicon
PATTERNS = (
    r"\byou(?:'re| are) (?:a |an |so |such )?(?:idiot|moron|loser|stupid|pathetic|worthless|disgusting|clown|trash|scum)",
    r"\b(?:idiot|moron|loser|clown|scum)s?\b",
    r"\b(?:stupid|pathetic|worthless|disgusting|trash)\b",
    r"\bshut (?:the \w+ )?up\b",
    r"\b(?:kill|hang|hurt) (?:yourself|you|them all)\b",
    r"\b(?:i|we) (?:hate|despise) (?:you|them|those)\b",
    r"\b(?:go|drop) (?:to hell|die|dead)\b",
    r"\b\w+[*@#$]{2,}\w*\b",
    r"(?:!\s*){3,}",
)
_PATTERNS = [re.compile(p) for p in PATTERNS]
_WORD = re.compile(r"\w+")
PIECE = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _word_set(text: str) -> set[str]:
    """Distinct lower-cased words, a piece of a long text at a time."""
    words: set[str] = set()
    for i in range(0, len(text), PIECE):
        j = i
        while i and j < len(text) and (text[j].isalnum() or text[j] == "_") and (text[j - 1].isalnum() or text[j - 1] == "_"):
            j += 1  # the word that a cut goes through belongs to the piece before
        end = i + PIECE
        while end < len(text) and (text[end].isalnum() or text[end] == "_") and (text[end - 1].isalnum() or text[end - 1] == "_"):
            end += 1
        words.update(_WORD.findall(text[j:end].lower()))
    return words


def word_features(word: str) -> list[str]:
    """The word itself (``=word``) and its beginnings (``^begi``)."""
    return [f"={word}"] + [f"^{word[:n]}" for n in STEMS if len(word) >= n]


def features(text: str) -> set[str]:
    """Names of all features of a text: words, beginnings, and patterns (``~number``)."""
    words = _word_set(text)
    out = {f for w in words for f in word_features(w)}
    low = text.lower()
    out.update(f"~{i}" for i, p in enumerate(_PATTERNS) if p.search(low))
    return out


@dataclass
class Model:
    """Weights of the features that the classifier kept; ``score`` is the logistic of their sum over a text."""

    bias: float
    weights: dict[str, float]
    voters: list[str] = field(default_factory=list)
    fires: np.ndarray | None = None  # chance that a voter fires in a clean, in a toxic document
    correlation: np.ndarray | None = None


@dataclass
class Sample:
    """Features of the labelled texts: ``names`` numbers them, ``col`` lists each document's, ``row`` its documents.

    ``weight`` is the number of labelled documents that each stands for, their mean being 1.
    """

    names: list[str]
    row: np.ndarray
    col: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(texts: list[str], toxic: list[int], stands_for: tuple[float, float] = (1.0, 1.0)) -> Sample:
        at: dict[str, int] = {}
        cols = [np.fromiter((at.setdefault(f, len(at)) for f in sorted(features(t))), np.int32) for t in texts]
        row = np.repeat(np.arange(len(cols), dtype=np.int32), [len(c) for c in cols])
        weight = np.where(np.array(toxic, bool), stands_for[1], stands_for[0])
        return Sample(list(at), row, np.concatenate([np.zeros(0, np.int32), *cols]), np.array(toxic, float), weight / max(weight.mean(), 1e-12) if len(weight) else weight)

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """Sum of the documents' weights for each feature."""
        return np.bincount(self.col, weight[self.row], len(self.names))


def lexicon(sample: Sample) -> list[int]:
    """Entries (words, beginnings) that mark toxic documents, the most telling first.

    At most MAX_CLEAN of the labelled documents that hold an entry may be clean, and it must be in so many of the sample that by
    chance not one of all candidates would be, but for a probability of CHANCE (Chernoff bound). Of
    entries that are in the same documents, as a word and its beginnings mostly are, the first by name speaks for all.
    """
    y = sample.toxic
    bad, good = sample.counts(y), sample.counts(1 - y)
    all_bad, all_good = sample.counts(y * sample.weight), sample.counts((1 - y) * sample.weight)
    n_bad, n_good = max(y.sum(), 1), max((1 - y).sum(), 1)
    base = n_bad / (n_bad + n_good)
    found = np.flatnonzero((bad >= MIN_FIRES) & np.array([f[0] != "~" for f in sample.names], bool))
    b, g = bad[found], good[found]
    share = np.minimum(b / (b + g), 1 - 1e-9)
    evidence = (b + g) * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
    pure = all_good[found] <= MAX_CLEAN * (all_bad[found] + all_good[found])
    chosen = np.flatnonzero(pure & (evidence >= np.log(max(len(found), 1) / CHANCE)))
    order = sorted(chosen, key=lambda k: (-evidence[k], sample.names[found[k]]))
    where: dict[int, list[int]] = {int(found[k]): [] for k in order}
    hit = np.isin(sample.col, found[chosen])
    for d, f in zip(sample.row[hit].tolist(), sample.col[hit].tolist(), strict=True):
        where[f].append(d)
    seen: set[tuple[int, ...]] = set()
    kept = []
    for k in order:
        documents = tuple(where[int(found[k])])
        if documents not in seen:
            seen.add(documents)
            kept.append(int(found[k]))
    return kept


def label_model(votes: np.ndarray, start: np.ndarray, prior: float, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the hidden label of each document from its votes (documents x voters, 0 or 1).

    A two-class generative model fitted by expectation-maximisation without the
    documents' labels, given the classes' balance ``prior``: each voter fires with one chance in clean and another in toxic documents; a voter
    that does not fire abstains, and one more voter fires where all others abstain. Voters
    that fire together beyond what the class explains (residual correlation) say the same thing twice: they
    form a group, of which only the strongest vote counts. ``start`` is the first guess of the posterior,
    ``weight`` the number of documents that each stands for.
    """
    weight = np.ones(len(votes)) if weight is None else weight
    votes = np.column_stack([votes, ~votes.any(axis=1)]).astype(float)
    n, m = votes.shape
    post, corr, group = start.astype(float), np.eye(m), np.arange(m)
    fires = np.full((2, m), 0.5)
    for round_ in range(ROUNDS):
        for c, p in ((0, 1 - post), (1, post)):
            fires[c] = ((p * weight) @ votes + 0.01) / ((p * weight).sum() + 1.0)
        if round_ in (5, 15):
            rest = votes - np.outer(1 - post, fires[0]) - np.outer(post, fires[1])
            rest *= np.sqrt(weight / weight.sum())[:, None]
            rest = (rest / (np.sqrt((rest**2).sum(axis=0)) + 1e-9)).astype(np.float32)
            corr = rest.T @ rest
            group, linked = np.arange(m), corr > MIN_CORRELATION
            linked[-1] = linked[:, -1] = False
            while (low := np.where(linked | np.eye(m, dtype=bool), group, m).min(axis=1)).tolist() != group.tolist():
                group = low
        evidence = votes * np.log(fires[1] / fires[0])
        logit = np.full(n, np.log(prior / (1 - prior)))
        for g in np.unique(group):
            e = evidence[:, group == g]
            logit += np.maximum(e.max(axis=1), 0) + np.minimum(e.min(axis=1), 0)
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post, fires, corr


def linear_classifier(sample: Sample, target: np.ndarray) -> tuple[float, dict[str, float]]:
    """L1-regularised logistic regression on binary features with soft targets (accelerated proximal steps).

    Features of under MIN_FIRES documents, or whose difference between the targets is within MIN_Z
    standard errors of none, are left out. Documents count by the number that they stand for.
    """
    n, mean, weight = len(target), target.mean(), sample.weight
    df = sample.counts(np.ones(n))
    z = np.abs(sample.counts(target - mean)) / np.sqrt(df * (1 - df / n) * (target.var() + 1e-9) + 1e-9)
    able = np.flatnonzero((df >= MIN_FIRES) & (df < n) & (z >= MIN_Z))
    kept = sorted(able, key=lambda f: (-z[f], sample.names[f]))
    names = [sample.names[f] for f in kept]
    place = np.full(len(sample.names), -1, np.int32)
    place[kept] = np.arange(len(kept))
    col = place[sample.col]
    row, col = sample.row[col >= 0], col[col >= 0]

    def gradient(w, b):
        z = np.bincount(row, w[col], n) + b
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        return np.bincount(col, r[row], len(names)) / n, r.mean()

    x, top = np.ones(len(names)), 1.0
    for _ in range(8):  # largest eigenvalue of X'WX / n, for the step
        x /= np.linalg.norm(x) + 1e-12
        x = np.bincount(col, (weight * np.bincount(row, x[col], n))[row], len(names)) / n
        top = np.linalg.norm(x)
    step = 3.0 / (top + 1)
    base = np.clip((weight * target).mean(), 0.01, 0.99)
    b = old_b = np.log(base / (1 - base))
    w = old = np.zeros(len(names))
    for k in range(STEPS):
        momentum = k / (k + 3)
        v, vb = w + momentum * (w - old), b + momentum * (b - old_b)
        gw, gb = gradient(v, vb)
        old, old_b = w, b
        w = v - step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b = vb - step * gb
    return float(b), {f: float(x) for f, x in zip(names, w, strict=True) if x}


def fit(texts: list[str], toxic: list[int], stands_for: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Fit voters, label model and classifier; with no labelled text every score is 0.01.

    ``stands_for``: how many labelled documents each clean and each toxic one of the sample stands for.
    """
    return fit_sample(Sample.of(texts, toxic, stands_for))


def fit_sample(sample: Sample) -> Model:
    """``fit`` on features that are there already; those of under MIN_FIRES documents, patterns apart, may be left out: none of them is used."""
    nothing = Model(float(np.log(0.01 / 0.99)), {})
    if not sample.toxic.any():
        return nothing
    entries = lexicon(sample)
    voters = entries + [i for i, f in enumerate(sample.names) if f[0] == "~"]
    if not voters:
        return nothing
    place = np.full(len(sample.names), -1, np.int32)
    place[voters] = np.arange(len(voters))
    votes = np.zeros((len(sample.toxic), len(voters)), bool)
    hit = place[sample.col] >= 0
    votes[sample.row[hit], place[sample.col[hit]]] = True
    start = np.where(votes[:, : len(entries) or None].any(axis=1), 0.9, 0.001)
    prior = float(np.clip((sample.toxic * sample.weight).mean(), 0.001, 0.999))
    post, fires, corr = label_model(votes, start, prior, sample.weight)
    bias, weights = linear_classifier(sample, post)
    return Model(bias, weights, [sample.names[v] for v in voters], fires, corr)


def _sample_features(batches):
    for batch in batches:
        found = [sorted(features(x.as_py())) for x in batch.column("t")]
        yield pa.RecordBatch.from_pydict({"_d": batch.column("_d"), "_toxic": batch.column("_toxic"), "f": pa.array(found, pa.list_(pa.string()))})


def sample_of(rows: DataFrame, sizes: dict[int, int]) -> Sample:
    """``Sample`` of the chosen documents (``_d, t, _toxic``), whose features tasks find, number and count.

    To the driver come a list of numbers per document and the names of the features that the model can use: patterns and those of
    MIN_FIRES documents. Names and lists are in the order of ``Sample.of``: by the first document that has them, then by name.
    """
    prepare_python(rows.sparkSession)
    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(_sample_features, f"_d {kinds['_d']}, _toxic {kinds['_toxic']}, f array<string>")
    found = materialise(found, "sample")
    each = found.select("_d", F.explode("f").alias("f"))
    used = each.groupBy("f").agg(F.count(F.lit(1)).alias("c"), F.min("_d").alias("first")).where((F.col("c") >= MIN_FIRES) | F.col("f").startswith("~"))
    used = materialise(used.select("f", (F.row_number().over(Window.orderBy("first", "f")) - 1).alias("k")), "sample-names")
    lists = each.join(used, "f").groupBy("_d").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "k"))), lambda x: x["k"]).alias("ks"))
    known = found.select("_d", "_toxic").join(lists, "_d", "left").orderBy("_d")
    known = known.select(F.col("_toxic").cast("double").alias("y"), F.coalesce("ks", F.array().cast("array<int>")).alias("ks")).toArrow().combine_chunks()
    names = used.orderBy("k").select("f").toArrow()["f"].to_pylist()
    toxic = known["y"].to_numpy()
    lists = known["ks"].combine_chunks()
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    taken = [min(sizes.get(0, 0), SAMPLE_CLEAN), min(sizes.get(1, 0), SAMPLE_TOXIC)]
    stands_for = [sizes.get(label, 0) / n if n else 1.0 for label, n in enumerate(taken)]
    weight = np.where(toxic > 0, stands_for[1], stands_for[0])
    return Sample(names, row, lists.flatten().to_numpy(), toxic, weight / max(weight.mean(), 1e-12) if len(weight) else weight)


def sample_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on up to SAMPLE_TOXIC + SAMPLE_CLEAN labelled documents, chosen by a hash of their id.

    The texts stay in the tasks (``sample_of``). Only labels of rows that are not ``held_out`` are read. Of several labels of a document the
    highest counts; of several rows of an id one. Documents of the sample are weighted by the share of their label that is in
    it, so that the classes' balance is that of all labelled rows whatever the table's size.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    known = known.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_d"), "_toxic")
    order = F.xxhash64(F.col("_d").cast("long"), F.lit(8))
    sizes = {r["_toxic"]: r["c"] for r in known.where(F.col("_toxic").isin(0, 1)).groupBy("_toxic").agg(F.count(F.lit(1)).alias("c")).collect()}

    def pick(label, n):
        # the least hashes lie below this bound but for a chance of under 1e-12, so that tasks send little more than the sample
        bound = F.lit(-(2.0**63) + 2.0**64 * min(1.0, 1.25 * n / sizes.get(label, 1)))
        return known.where((F.col("_toxic") == label) & (order.cast("double") <= bound)).orderBy(order, "_d").limit(n)

    # a table of SAMPLE_TOXIC + SAMPLE_CLEAN rows at most
    chosen = F.broadcast(pick(1, SAMPLE_TOXIC).union(pick(0, SAMPLE_CLEAN)))
    texts = docs.select(F.col(id_col).alias("_i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = texts.join(chosen, F.col("_i") == F.col("_d")).groupBy("_d").agg(F.max(F.struct("t", "_toxic")).alias("m")).select("_d", "m.*")
    return fit_sample(sample_of(rows, sizes))


def _score(model: Model):
    weights, bias = model.weights, model.bias
    patterns = [(f"~{i}", i) for i in range(len(PATTERNS)) if f"~{i}" in weights]

    def run(batches):
        hits: dict[str, tuple[str, ...]] = {}  # word -> its features that have a weight
        for batch in batches:
            out = []
            for x in batch.column("t"):
                text = x.as_py() or ""
                found: set[str] = set()
                for w in _word_set(text):
                    h = hits.get(w)
                    if h is None:
                        h = hits[w] = tuple(f for f in word_features(w) if f in weights)
                    if h:
                        found.update(h)
                if patterns:
                    low = text.lower()
                    found.update(name for name, i in patterns if _PATTERNS[i].search(low))
                # a fixed order of summation: equal texts get equal scores
                out.append(bias + sum(weights[f] for f in sorted(found)))
                if len(hits) > CACHED_WORDS:
                    hits.clear()
            score = 1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30)))
            yield pa.RecordBatch.from_pydict({"_row": batch.column("_row"), "doc_id": batch.column("doc_id"), "score": pa.array(score, pa.float64())})

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``_row, doc_id, held_out, score, predicted`` for every row of ``docs``.

    The score reads the text alone. Null and empty texts are scored by the bias; equal texts get equal
    scores; an empty table gives an empty result; other columns are ignored.
    """
    prepare_python(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = with_row_key(stored(docs), "_row", doc_id=F.col(id_col), t=F.col(text_col))
    scored = rows.mapInArrow(_score(model), f"_row long, doc_id {kind}, score double")
    return scored.select(
        "_row",
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, all columns kept."""
    docs = stored(docs)
    gone = score(docs, sample_model(docs, labels, **settings), threshold=threshold, **settings).where("predicted = 1")
    gone = gone.select(F.col("_row").alias("_gone"))
    packed = with_row_key(docs, "_row", d=whole_row(docs))
    return packed.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("d.*")
