"""Secret scan: known formats, and a battery of randomness tests.

Base kinds (assignments, access keys, hex runs) are patterns. The method adds
``random`` spans: runs of 20 or more characters of the base-64 alphabets that
no base span touches, read in the smallest encoding that fits (hex, also with
hyphens between its groups as in a UUID, letters of one case, base 32, letters
and digits, base 64). Three statistics of a run decide:

* the uniformity of its characters over the alphabet (chi-squared),
* the runs above and below the middle of the alphabet, and
* the correlation of neighbouring characters.

Each is used twice. Against uniform draws of the encoding, a run is set aside
if one of them is further off than ``ACCEPT`` standard deviations. Against
ordinary words, whose characters and neighbouring pairs are counted over the
distinct words of the whole corpus (words under 20 characters), each gives the likelihood ratio of
uniform draws to the word model: of the characters one by one, of the changes
between the halves of the alphabet, of each character after its neighbour.
Under the word model the mean of a ratio is 1, and so is that of the average of
the three, however they depend on each other: it is an e-value, 1/e a p-value,
and it grows with the length of a run. Over all runs of the corpus outside base
spans, the Benjamini-Hochberg procedure on these holds the share of false
discoveries at ``false_share``, copies and other dependence included. Its
threshold comes from counts of runs in fixed bins.

Only built-in expressions are used; the distinct short words and the bins are
all that is shuffled.

Defined cases: a null text counts as empty; a text without matches has counts
0, the SHA-256 of the empty string and empty spans; repeated rows count each;
a table without any run flags nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S

#: The base patterns.
ASSIGN = (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"                              # runs of 18 and more
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_-]{20,}"

FALSE_SHARE = 0.01
#: Largest deviation, in standard deviations, that a test accepts.
ACCEPT = 3.3
_BIN = 0.1
_MOST = 1000.0


def _letters(*spans: str) -> str:
    return "".join(chr(c) for a, b in spans for c in range(ord(a), ord(b) + 1))


_DIGIT, _UPPER, _LOWER = ("0", "9"), ("A", "Z"), ("a", "z")
#: Encodings from small to large: the alphabets in their order.
ENCODINGS = [_letters(_DIGIT, ("a", "f")), _letters(_DIGIT, ("A", "F")), _letters(_LOWER), _letters(_UPPER),
             _letters(_UPPER, ("2", "7")), _letters(_DIGIT, _UPPER), _letters(_DIGIT, _LOWER),
             _letters(_DIGIT, _UPPER, _LOWER), _letters(_DIGIT, _UPPER, _LOWER) + "+/_-"]
ALL = ENCODINGS[-1]
#: Words of the word model are shorter than the runs that are tested.
WORD_CHARS = 19
#: Share of uniform draws mixed into the word model, so that no character is impossible.
_FLOOR = 0.05


def _body(run: Column) -> Column:
    """The run without the hyphens between groups of hex digits."""
    grouped = run.rlike("^[0-9a-f]+(-[0-9a-f]+)+$") | run.rlike("^[0-9A-F]+(-[0-9A-F]+)+$")
    return F.when(grouped, F.translate(run, "-", "")).otherwise(run)


def _alphabet(body: Column) -> Column:
    """The characters of the smallest encoding that the run fits."""
    out = None
    for e in ENCODINGS[:-1]:
        fits = F.char_length(F.translate(body, e, "")) == 0
        out = F.when(fits, F.lit(e)) if out is None else out.when(fits, F.lit(e))
    return out.otherwise(F.lit(ALL))


def _read(run: Column, use) -> Column:
    """use(alphabet, characters, their places in the alphabet)."""
    return S.let(_body(run), lambda body: S.let(_alphabet(body), lambda letters: S.let(F.split(body, ""), lambda chars: S.let(
        F.transform(chars, lambda c: F.position(c, letters).cast("double") - 1), lambda at: use(letters, chars, at)))))


def _sums(values: Column, f) -> Column:
    return F.aggregate(F.transform(values, f), F.lit(0.0), lambda a, x: a + x)


def _half_changes(a: Column, at: Column) -> Column:
    return F.size(F.filter(F.sequence(F.lit(1), F.size(at) - 1),
                           lambda i: (F.get(at, i) >= a / 2) != (F.get(at, i - 1) >= a / 2))).cast("double")


def looks_random(run: Column) -> Column:
    """Whether no test of the battery rejects uniform draws from the run's encoding."""
    def tests(letters: Column, chars: Column, at: Column) -> Column:
        a, n = F.char_length(letters).cast("double"), F.size(chars).cast("double")
        pairs = F.sequence(F.lit(1), F.size(chars) - 1)
        squares = _sums(F.array_distinct(chars), lambda c: F.pow(F.size(F.filter(chars, lambda x: x == c)), F.lit(2.0)))
        z_chi = (squares * a / n - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
        up = F.size(F.filter(at, lambda x: x >= a / 2)).cast("double")
        mean = 2 * up * (n - up) / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = F.when(spread > 0, F.abs(1 + _half_changes(a, at) - mean) / F.sqrt(spread)).otherwise(F.lit(99.0))

        def serial(middle: Column) -> Column:
            power = _sums(at, lambda x: (x - middle) * (x - middle))
            together = _sums(pairs, lambda i: (F.get(at, i) - middle) * (F.get(at, i - 1) - middle))
            return F.when(power > 0, F.abs(together / power) * F.sqrt(n)).otherwise(F.lit(99.0))

        z_serial = S.let(_sums(at, lambda x: x) / n, serial)
        return (z_chi <= ACCEPT) & (z_runs <= ACCEPT) & (z_serial <= ACCEPT)

    return _read(run, tests)


class WordModel:
    """Characters, neighbouring pairs and half changes of the corpus's words, from counts of pairs.

    ``pairs`` holds (place of the earlier character in ALL or -1 at a word's start, place of the character, count).
    """

    def __init__(self, pairs: list[tuple[int, int, int]]):
        size = len(ALL)
        one, two = [0.0] * size, [[0.0] * size for _ in range(size)]
        for p, c, n in pairs:
            one[c] += n
            if p >= 0:
                two[p][c] += n
        total = sum(one)
        flat = [(n + 1) / (total + size) for n in one]
        mixed = [(1 - _FLOOR) * f + _FLOOR / size for f in flat]
        self.one = [-math.log(f) for f in mixed]
        self.two = [-math.log((1 - _FLOOR) * (row[c] + 5 * flat[c]) / (sum(row) + 5) + _FLOOR / size)
                    for row in two for c in range(size)]
        self.changes = {}                                 # alphabet: log ratios of a change and of no change
        for e in ENCODINGS:
            upper = {ALL.index(x): i >= len(e) / 2 for i, x in enumerate(e)}
            met = [(upper[p] != upper[c], two[p][c]) for p in upper for c in upper]
            word = (sum(n for change, n in met if change) + 1) / (sum(n for _, n in met) + 2)
            high = sum(upper.values()) / len(e)
            even = 2 * high * (1 - high)
            self.changes[e] = (math.log(even / word), math.log((1 - even) / (1 - word)))


def word_model(docs: DataFrame, *, text: str = "text") -> WordModel:
    """Counted over all distinct words of docs of at most WORD_CHARS characters, so that copies and frequent words
    do not make a small vocabulary look certain; at most 67 x 66 counts come to the driver."""
    words = (docs.select(F.explode(F.split(F.col(text), "[^A-Za-z0-9+/_-]+")).alias("w"))
             .where(F.char_length("w").between(1, WORD_CHARS)).distinct())
    at = words.select(F.transform(F.split("w", ""), lambda c: F.position(c, F.lit(ALL)) - 1).alias("at"))
    pairs = at.select(F.explode(F.transform("at", lambda c, i: F.struct(
        F.when(i > 0, F.get(F.col("at"), i - 1)).otherwise(F.lit(-1)).alias("p"), c.alias("c")))).alias("x"))
    return WordModel([(r["p"], r["c"], r["n"]) for r in
                      pairs.groupBy("x.p", "x.c").agg(F.count(F.lit(1)).alias("n")).collect()])


def _constants(values: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{v:.6f}" for v in values)), ",").cast("array<double>")


def evidence(run: Column, model: WordModel) -> Column:
    """Log of the run's e-value: the average of the three likelihood ratios of uniform draws to the word model."""
    one, two = _constants(model.one), _constants(model.two)
    ratios = F.create_map(*[x for e, (change, same) in model.changes.items()
                            for x in (F.lit(e), F.array(F.lit(change), F.lit(same)))])

    def logs(letters: Column, chars: Column, at: Column) -> Column:
        a, n = F.char_length(letters).cast("double"), F.size(chars).cast("double")

        def of(place: Column) -> Column:
            pairs = F.sequence(F.lit(1), F.size(chars) - 1)
            alone = _sums(place, lambda c: F.get(one, c)) - n * F.ln(a)
            after = (F.get(one, F.get(place, F.lit(0))) - n * F.ln(a)
                     + _sums(pairs, lambda i: F.get(two, F.get(place, i - 1) * len(ALL) + F.get(place, i))))
            r = F.element_at(ratios, letters)
            halves = S.let(_half_changes(a, at), lambda k: k * F.get(r, F.lit(0)) + (n - 1 - k) * F.get(r, F.lit(1)))
            return F.array(alone, after, halves)

        return S.let(F.transform(chars, lambda c: F.position(c, F.lit(ALL)) - 1), of)

    def average(logs: Column) -> Column:
        return S.let(F.array_max(logs), lambda top: top + F.ln(_sums(logs, lambda x: F.exp(x - top)) / 3))

    return S.let(_read(run, logs), average)


def evidence_threshold(docs: DataFrame, model: WordModel, *, text: str = "text",
                       false_share: float = FALSE_SHARE) -> float:
    """Least log e-value that the Benjamini-Hochberg procedure accepts over the tested runs of docs; infinite if none."""
    runs = (docs.where(F.col(text).rlike(RUN)).select(F.col(text).alias("t"))
            .select("t", *[c.alias(k) for k, c in _base(F.col("t")).items()], S.matches(F.col("t"), RUN).alias("runs"))
            .select(F.explode(_outside_base()).alias("run")))
    score = F.greatest(F.lit(0.0), F.least(evidence(F.col("run.m"), model), F.lit(_MOST)))
    bins = runs.select(F.floor(score / _BIN).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # at most _MOST / _BIN + 1 rows
    counts = sorted(((r["bin"], r["n"]) for r in bins.collect()), reverse=True)
    total, above, least = sum(n for _, n in counts), 0, math.inf
    for b, n in counts:
        above += n
        if -b * _BIN <= math.log(false_share * above / total):
            least = b * _BIN
    return least


def _outside_base() -> Column:
    """The runs that no base span touches."""
    return S.let(F.concat("assign", "access", "hex"), lambda base: F.filter(
        "runs", lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))))


def _base(text: Column) -> dict[str, Column]:
    assign = F.when(text.rlike(ASSIGN), F.filter(
        S.matches(text, ASSIGN), lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 12)).otherwise(S.none())
    return {"assign": assign, "access": S.matches(text, ACCESS), "hex": S.matches(text, HEX)}


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
         false_share: float = FALSE_SHARE) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row of docs."""
    model = word_model(docs, text=text)
    least = evidence_threshold(docs, model, text=text, false_share=false_share)
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).alias("doc_id"), body.alias("t"))
    d = d.select("doc_id", *[c.alias(k) for k, c in _base(F.col("t")).items()], S.matches(F.col("t"), RUN).alias("runs"))
    found = F.filter(_outside_base(), lambda x: (evidence(x["m"], model) >= least) & looks_random(x["m"])) \
        if least < math.inf else S.none()
    d = d.select("*", found.alias("random"))

    def ordered(kinds):
        """"kind:start:end" by start, then kind as listed, comma-joined."""
        def tag(i, kind):
            return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("i"), F.concat(
                F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")).alias("t")))
        tagged = [tag(i, kind) for i, kind in enumerate(kinds)]
        return F.array_join(F.transform(F.sort_array(F.concat(*tagged)), lambda x: x["t"]), ",")

    kinds = ["assign", "access", "hex"]
    return d.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
                    F.sha2(ordered(kinds), 256).alias("base_sha256"), ordered([*kinds, "random"]).alias("spans"))
