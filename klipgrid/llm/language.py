"""Languages of documents and of their passages, by fusing evidence.

Pass one reads the texts: words score under a model per language and script, and
neighbours that favour the same one are summed, so a text becomes a short list of
runs.  Grouped aggregations over all documents then give smoothed priors: what a
declared label is worth, and which languages an address carries, the address
shrunk to its host, the host to its suffix and the suffix to the whole corpus.
Pass two joins the priors to the runs and finds passages by a Viterbi path in
which they count: at its start, and whenever it goes over to another language.
The posterior of a passage is its likelihood, tempered by what held-out sentences
show it to be worth, times its prior.  The texts are read once.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import join_unique
from ..session import cut

MAX_SAMPLES = 100_000  # labelled sentences the model is fitted on
MAX_TRIALS = 1_500  # of these, held out in turn to temper the likelihood
PASSAGE = 5  # consecutive words
SWITCH = 9.0  # nats lost by going over to another language
STRAY = 8.0  # nats: a word may stray into any passage with a chance of exp(-STRAY)
KAPPA_URL, KAPPA_HOST, KAPPA_SUFFIX, KAPPA_LABEL = 5.0, 20.0, 100.0, 5.0  # strength of what a count is shrunk to

_WORD = regex.compile(r"[\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)*")
_MARKUP = re.compile(r"<[^<>]*>")
_LINK = re.compile(r"(?:https?:|ftp:|www\.)|\w@\w|^[#@]\w|\.\w{2,}/", re.I)
_CACHE = 1 << 17


def _script(c: str) -> str:
    return unicodedata.name(c, "?").split(" ")[0]


def script_of(word: str) -> str:
    """Script of the first letter that has one."""
    for c in word:
        if unicodedata.category(c)[0] == "L":
            return _script(c)
    return "?"


def words_of(token: str) -> list[str]:
    """Words of a token between blanks: folded letters, no links, tags or filler."""
    if _LINK.search(token):
        return []
    # invisible characters inside a word don't divide it
    text = "".join(c for c in unicodedata.normalize("NFKC", token).lower() if unicodedata.category(c) != "Cf")
    out = []
    for w in _WORD.findall(text):
        if len(w) > 4 and len(set(w)) == 1:
            continue
        if any(unicodedata.category(c)[0] == "L" for c in w):
            out.append(w)
    return out


def tokens_of(text: str) -> list[str]:
    """Tokens of a text without markup."""
    if "<" in text:
        text = _MARKUP.sub(" ", text)
    return text.split()


class WordModel:
    """log P(word | variant), a variant being a language in one script.

    Counts of seen words are shrunk to a character trigram model of the variant,
    so unseen spellings still tell languages apart.
    """

    def __init__(self, samples: list[tuple[str, str]], kappa: float = 30.0) -> None:
        words: dict[tuple[str, str], Counter] = defaultdict(Counter)
        for lang, text in samples:
            for t in tokens_of(text or ""):
                for w in words_of(t):
                    words[lang, script_of(w)][w] += 1
        # a stray word of another script in a sample makes no variant
        total = Counter()
        for (lang, _), c in words.items():
            total[lang] += sum(c.values())
        self.variants = sorted(v for v, c in words.items() if sum(c.values()) >= 0.05 * total[v[0]])
        self.langs = sorted({lang for lang, _ in self.variants})
        self.lang_of = np.array([self.langs.index(lang) for lang, _ in self.variants], dtype=np.int64)
        self.words = [words[v] for v in self.variants]
        self.sizes = [sum(c.values()) for c in self.words]
        self.kappa = kappa
        self.grams = []
        for c in self.words:
            tri, bi = Counter(), Counter()
            for w, n in c.items():
                s = f"^^{w}$"
                for i in range(len(s) - 2):
                    tri[s[i : i + 3]] += n
                    bi[s[i : i + 2]] += n
            uni = Counter(ch for w, n in c.items() for ch in w + "$" for _ in range(n))
            self.grams.append((tri, bi, uni, sum(uni.values())))

    def _spelled(self, v: int, w: str) -> float:
        """log probability of the letters of ``w``; trigrams shrunk to single letters."""
        tri, bi, uni, n = self.grams[v]
        s, out = f"^^{w}$", 0.0
        for i in range(len(s) - 2):
            base = (uni[s[i + 2]] + 0.5) / (n + 100.0)
            out += math.log((tri[s[i : i + 3]] + 2.0 * base) / (bi[s[i : i + 2]] + 2.0))
        return out

    def score(self, word: str) -> np.ndarray:
        """log P(word | variant), a stray word of the best variant being possible in all of them."""
        kind = script_of(word)
        out = np.full(len(self.variants), -np.inf)
        for v, (_, script) in enumerate(self.variants):
            if script == kind:
                spelled = math.exp(max(-300.0, self._spelled(v, word)))
                out[v] = math.log((self.words[v][word] + self.kappa * spelled) / (self.sizes[v] + self.kappa) + 1e-130)
        best = out.max()
        if not np.isfinite(best):
            return np.zeros(len(self.variants))  # a script of no known language says nothing
        return np.logaddexp(out, best - STRAY)

    def by_language(self, sums: np.ndarray) -> np.ndarray:
        """Sums by variant as sums by language, each in its best script."""
        out = np.full(len(self.langs), -np.inf)
        np.maximum.at(out, self.lang_of, sums)
        return out


class Reader:
    """Texts as runs: how many words, and their summed scores by variant."""

    def __init__(self, model: WordModel) -> None:
        self.model = model
        self.reset()

    def reset(self) -> None:
        """Empty the cache of tokens, which changes no result."""
        self.tokens: dict[str, tuple[int, ...]] = {}
        self.index: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, len(self.model.variants)))

    def _token(self, t: str) -> tuple[int, ...]:
        out = []
        for w in words_of(t):
            i = self.index.get(w)
            if i is None:
                s = self.model.score(w)
                if not s.any():
                    continue
                i = self.index[w] = len(self.rows)
                self.rows.append(s - s.max())
            out.append(i)
        got = self.tokens[t] = tuple(out)
        return got

    def scores(self, text: str | None) -> np.ndarray:
        """One row per word, 0 for its best variant."""
        if not text:
            return np.zeros((0, len(self.model.variants)))
        if len(self.tokens) > _CACHE:
            self.reset()
        seen, out = self.tokens, []
        for t in tokens_of(text):
            got = seen.get(t)
            if got is None:
                got = self._token(t)
            out += got
        if len(self.rows) > len(self.table):
            self.table = np.array(self.rows)
        return self.table[np.array(out, dtype=np.int64)]

    def runs(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(words, sums by variant) of each run: neighbours whose best variant is the same."""
        scores = self.scores(text)
        if not len(scores):
            return np.zeros(0, np.int64), scores
        top = scores.argmax(axis=1)
        cuts = np.r_[0, np.flatnonzero(top[1:] != top[:-1]) + 1]
        if -scores.sum(axis=0).max() < 1.0:  # hardly a nat in it for any other variant: no prior makes a switch pay
            cuts = cuts[:1]
        return np.diff(np.r_[cuts, len(scores)]), np.add.reduceat(scores, cuts, axis=0)


class Fuser:
    """Passages of a list of runs under a prior, with their posteriors.

    A likelihood over n words counts ``weight * n ** -damp`` times: words of one
    passage repeat each other, so their evidence grows more slowly than their number.
    """

    def __init__(self, model: WordModel, temper: tuple[float, float] = (1.0, 0.0), switch: float = SWITCH, passage: int = PASSAGE) -> None:
        self.model, self.temper, self.switch, self.passage = model, temper, switch, passage

    def path(self, sums: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """Best variant of each run; ``prior`` by variant, at most 0."""
        best = int((sums.sum(axis=0) + prior).argmax())
        if (sums.max(axis=1) - sums[:, best]).sum() - prior[best] < self.switch:
            return np.full(len(sums), best)  # whatever a switch may gain, it costs more
        fee = (prior - self.switch).tolist()
        rows = sums.tolist()
        alpha, back = [a + b for a, b in zip(rows[0], prior.tolist(), strict=True)], []
        for row in rows[1:]:
            m = max(alpha)
            j = alpha.index(m)
            back.append([i if a >= m + f else j for i, (a, f) in enumerate(zip(alpha, fee, strict=True))])
            alpha = [(a if a >= m + f else m + f) + r for a, f, r in zip(alpha, fee, row, strict=True)]
        at = alpha.index(max(alpha))
        states = [at]
        for b in reversed(back):
            at = b[at]
            states.append(at)
        return np.array(states[::-1])

    def posterior(self, sums: np.ndarray, n: int, prior: np.ndarray) -> np.ndarray:
        """P(language | n words, prior); ``sums`` by variant."""
        weight, damp = self.temper
        lp = self.model.by_language(sums) * (weight * n**-damp) + prior
        e = np.exp(lp - lp.max())
        return e / e.sum()

    def passages(self, counts: np.ndarray, sums: np.ndarray, prior: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(first word, words, posterior by language) of each stretch; short ones join a neighbour."""
        if not len(counts):
            return []
        prior = prior - prior.max()
        lang = self.model.lang_of[self.path(sums, prior[self.model.lang_of])]
        cuts = np.r_[0, np.flatnonzero(lang[1:] != lang[:-1]) + 1]
        ends = np.r_[cuts[1:], len(lang)]
        parts = [[int(lang[a]), int(counts[a:b].sum()), int(b)] for a, b in zip(cuts, ends, strict=True)]
        while len(parts) > 1:
            i = min(range(len(parts)), key=lambda j: parts[j][1])
            if parts[i][1] >= self.passage:
                break
            near = [j for j in (i - 1, i + 1) if 0 <= j < len(parts)]
            parts[i][0] = parts[max(near, key=lambda x: parts[x][1])][0]
            merged: list[list[int]] = []
            for r in parts:
                if merged and merged[-1][0] == r[0]:
                    merged[-1][1:] = [merged[-1][1] + r[1], r[2]]
                else:
                    merged.append(r)
            parts = merged
        out, at, word = [], 0, 0
        for _, n, b in parts:
            out.append((word, n, self.posterior(sums[at:b].sum(axis=0), n, prior)))
            at, word = b, word + n
        return out


def trials(samples: list[tuple[str, str]], folds: int = 3, lengths: tuple[int, ...] = (5, 10, 20, 40)) -> list[tuple[str, int, dict[str, float]]]:
    """(true language, words, log likelihood by language) of stretches that a model hasn't seen.

    Each fold is held out in turn; its sentences of one language and script stand
    behind one another and are cut into stretches of each length.
    """
    out = []
    for f in range(folds):
        model = WordModel([x for i, x in enumerate(samples) if i % folds != f])
        reader, rows = Reader(model), defaultdict(list)
        for lang, text in (x for i, x in enumerate(samples) if i % folds == f):
            words = [w for t in tokens_of(text or "") for w in words_of(t)]
            if words:
                rows[lang, script_of(words[0])].append(reader.scores(text))
        for (lang, _), parts in rows.items():
            whole = np.concatenate(parts)
            for n in lengths:
                for a in range(0, len(whole) - n + 1, n):
                    out.append((lang, n, dict(zip(model.langs, model.by_language(whole[a : a + n].sum(axis=0)), strict=True))))
    return out


def _confidences(tried: list[tuple[str, int, dict[str, float]]], weight: float, damp: float) -> list[tuple[float, float, bool]]:
    """(probability of the truth, confidence, right?) of each stretch, all languages being equally likely before."""
    out = []
    for lang, n, ll in tried:
        k = weight * n**-damp
        top = max(ll.values())
        e = {x: math.exp((v - top) * k) for x, v in ll.items()}
        z, best = sum(e.values()), max(e, key=lambda x: (e[x], x))
        out.append((e.get(lang, 0.0) / z, e[best] / z, best == lang))
    return out


def tempered(tried: list[tuple[str, int, dict[str, float]]]) -> tuple[float, float]:
    """(weight, damp) with the least log loss on held-out stretches; (1, 0) without any.

    A few hundred sentences may all be named right, which would call for endless
    sharpness.  So, as one always does who has seen no failure yet, one is added:
    of each length the narrowest stretch is counted as wrong once more.
    """
    if not tried:
        return 1.0, 0.0

    def loss(weight: float, damp: float) -> float:
        got, worst = 0.0, {}
        for (_, n, _), (p, sure, _) in zip(tried, _confidences(tried, weight, damp), strict=True):
            got -= math.log(max(p, 1e-12))
            worst[n] = min(worst.get(n, 1.0), sure)
        return got - sum(math.log(max(1e-12, 1 - x)) for x in worst.values())

    return min(((w, d) for d in (0.0, 0.25, 0.5) for w in (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9, 1.0, 1.25, 1.5, 2.0, 3.0)), key=lambda x: loss(*x))


def calibration_error(tried: list[tuple[str, int, dict[str, float]]], weight: float, damp: float, bins: int = 10) -> float:
    """Mean distance of confidence and share of right answers, over bins of confidence."""
    got = _confidences(tried, weight, damp)
    by = defaultdict(list)
    for _, c, right in got:
        by[min(bins - 1, int(c * bins))].append((c, right))
    return sum(abs(sum(c for c, _ in b) - sum(r for _, r in b)) for b in by.values()) / max(1, len(got))


_RUNS = T.ArrayType(T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.ArrayType(T.FloatType(), False))]))


def _read_texts(df: DataFrame, model: WordModel, key: str, text: str, label: str, url: str) -> DataFrame:
    """(key, label, url, runs, guess): pass one; ``guess`` is the likeliest language of all words, null without any."""
    schema = T.StructType([df.schema[key], *[T.StructField(c, T.StringType()) for c in ("label", "url")], T.StructField("runs", _RUNS), T.StructField("guess", T.StringType())])
    kind = pa.list_(pa.struct([("n", pa.int32()), ("s", pa.list_(pa.float32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, k = Reader(model), len(model.variants)
        for b in batches:
            n, sums, offsets, guess = [], [], [0], []
            for t in b.column(3).to_pylist():
                counts, part = reader.runs(t)
                n.append(counts)
                sums.append(part)
                offsets.append(offsets[-1] + len(counts))
                guess.append(model.langs[int(model.by_language(part.sum(axis=0)).argmax())] if len(counts) else None)
            flat = np.concatenate([np.zeros((0, k)), *sums]).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * k, pa.int32()), pa.array(flat.ravel()))
            rows = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *n]), pa.int32()), lists], names=["n", "s"])
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows).cast(kind)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), runs, pa.array(guess, pa.string())], names=schema.names)

    return df.select(key, F.col(label).cast("string"), F.col(url).cast("string"), text).mapInArrow(run, schema)


def address_host(url: str) -> Column:
    """Host name of a URL in small letters; '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*://)?([^/:?#]*)", 1))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def _keyed(c: str) -> Column:
    """A column as a key that nulls have, too."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))


def fused_priors(read: DataFrame, langs: list[str]) -> tuple[DataFrame, DataFrame]:
    """(_url, prior) and (_label, evidence): log priors by language, from all documents.

    P(l | address) is shrunk to P(l | host), that to P(l | suffix), that to P(l);
    P(label | l) is shrunk to P(label).  Nulls are an address and a label of their own.
    """
    k = len(langs)
    seen = read.where(F.col("guess").isNotNull())
    counts = lambda df, by: df.groupBy(*by).agg(F.array(*[F.sum(F.when(F.col("guess") == x, 1).otherwise(0)).cast("double") for x in langs]).alias("c"))
    add = lambda df, by, name: df.groupBy(*by).agg(F.array(*[F.coalesce(F.sum(F.col("c")[i]), F.lit(0.0)) for i in range(k)]).alias(name))
    shrunk = lambda c, to, kappa: F.zip_with(c, to, lambda x, y: (x + kappa * y) / (_total(F.col(c)) + kappa))
    urls = cut(counts(seen.withColumns({"_url": _keyed("url"), "host": address_host("url")}), ["_url", "host"]).withColumn("suffix", F.substring_index("host", ".", -1)))
    whole = add(urls, [], "c").select(F.transform("c", lambda x: (x + 1) / (_total(F.col("c")) + k)).alias("w"))
    suffix = add(urls, ["suffix"], "c").join(F.broadcast(whole)).select("suffix", shrunk("c", "w", KAPPA_SUFFIX).alias("ps"))  # one row
    hosts = add(urls, ["suffix", "host"], "c").join(suffix, "suffix").select("host", shrunk("c", "ps", KAPPA_HOST).alias("ph"))
    prior = cut(urls.join(hosts, "host").select("_url", F.transform(shrunk("c", "ph", KAPPA_URL), lambda x: F.log(x)).alias("prior")))
    labels = cut(counts(seen.withColumn("_label", _keyed("label")), ["_label"]))
    labels = labels.join(F.broadcast(add(labels, [], "t")))  # one row
    share = _total(F.col("c")) / F.greatest(_total(F.col("t")), F.lit(1.0))
    return prior, cut(labels.select("_label", F.zip_with("c", "t", lambda x, y: F.log((x + KAPPA_LABEL * share) / (y + KAPPA_LABEL))).alias("evidence")))


def _fuse(model: WordModel, temper: tuple[float, float], passage: int, key: T.StructField):  # noqa: ANN202
    """Pass two: (key, label, lang, confidence, first, n) from (key, label, runs, prior, evidence)."""
    names = [key.name, "label", "lang", "confidence", "first", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fuser, k = Fuser(model, temper, passage=passage), len(model.variants)
        for b in batches:
            if not b.num_rows:
                continue
            runs = b.column(2)
            off = runs.offsets.to_numpy()
            rows = runs.values  # a struct's children keep the slice of their parent
            counts = rows.field("n").to_numpy(zero_copy_only=False)
            sums = rows.field("s").values.to_numpy(zero_copy_only=False).reshape(-1, k).astype(np.float64)
            prior = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) + b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            take, lang, sure, first, n = [], [], [], [], []
            for i in range(b.num_rows):
                for at, words, post in fuser.passages(counts[off[i] : off[i + 1]], sums[off[i] : off[i + 1]], prior[i]):
                    if words >= passage:
                        best = int(post.argmax())
                        take.append(i)
                        lang.append(model.langs[best])
                        sure.append(float(post[best]))
                        first.append(at)
                        n.append(words)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(lang, pa.string()), pa.array(sure, pa.float64()), pa.array(first, pa.int32()), pa.array(n, pa.int32())], names=names)

    return run


def detect_passages(df: DataFrame, key: str, text: str, label: str, url: str, samples: DataFrame, lang: str = "lang", sample: str = "sample", passage: int = PASSAGE) -> DataFrame:
    """Passages of every document: (key, label, lang, confidence, first, n).

    ``first`` and ``n`` count words; a passage has at least ``passage`` words of one
    language, in whatever script.  Null, empty and wordless texts give no row.
    ``confidence`` is the posterior of the language: tempered likelihood, prior of
    the address (``url``) and worth of the ``label``.  ``samples`` are labelled
    sentences, at most ``MAX_SAMPLES`` of which (by hash) fit the word model and at
    most ``MAX_TRIALS`` its temper; without any there are no languages and no rows.
    An empty table gives no rows.
    """
    rows = samples.where(F.col(lang).isNotNull() & F.col(sample).isNotNull()).select(lang, sample)
    fit = [(r[0], r[1]) for r in rows.orderBy(F.xxhash64(lang, sample), lang, sample).limit(MAX_SAMPLES).collect()]
    model = WordModel(fit)
    out = T.StructType([df.schema[key], T.StructField("label", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("first", T.IntegerType()), T.StructField("n", T.IntegerType())])
    if not model.langs:
        return df.sparkSession.createDataFrame([], out)
    temper = tempered(trials(fit[:MAX_TRIALS]))
    read = cut(_read_texts(df, model, key, text, label, url))
    prior, evidence = fused_priors(read, model.langs)
    known = read.where("guess is not null").select(F.col(key).alias("_key"), "label", "runs", _keyed("url").alias("_url"), _keyed("label").alias("_label"))
    both = join_unique(join_unique(known, prior, "_url"), evidence, "_label").select(F.col("_key").alias(key), "label", "runs", "prior", "evidence")
    return both.mapInArrow(_fuse(model, temper, passage, df.schema[key]), out)


def label_cases(passages: DataFrame, key: str, codes: DataFrame, code: str = "code", lang: str = "lang") -> DataFrame:
    """(key, lang): languages of documents whose label is missing, wrong or not enough.

    ``codes`` names the language of each spelling of a label.  One row per case
    and language of its passages.
    """
    by = passages.groupBy(key).agg(F.collect_set("lang").alias("langs"), F.first("label").alias("label"))
    named = codes.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("label")).agg(F.collect_set(lang).alias("named"))
    out = by.join(named, "label", "left")
    right = F.coalesce(F.arrays_overlap("named", "langs"), F.lit(False)) & (F.size("langs") == 1)
    return out.where(~right).select(key, F.explode("langs").alias("lang"))
