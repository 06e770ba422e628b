"""Personal data: base kinds, and information-theoretic sanitisation of terms.

Base kinds (email, ip, card, phone) are patterns with checks. The method then
asks which other terms give a protected entity (one address, one number) away.
Over the N different lines of the corpus, with c the number of lines,

    disclosure(e, t) = log(N c(e, t) / (c(e) c(t))) / log(N / c(e))

is the share of an entity's information that seeing the term reveals; it is 1
plus the logarithm of c(e, t) / c(t) over that of N / c(e). Few lines prove
little: a term counts as revealing where the disclosure with the lower Wilson
bound (``z`` standard errors) of c(e, t) / c(t) in its place reaches
``generalise_at``. Of the revealing terms, those whose disclosure reaches
``remove_at`` for some entity are removed and the others generalised, in every
document, whether it holds the entity or not.

A term is generalised to the corpus's own broader term: of the terms that
stand in at least ``BROADER_SHARE`` of its lines, in more lines than it, and that
reveal no entity themselves, the one in the fewest lines (ties: the smallest).
Where there is none, a fixed mark is put.

All four count each different line once, so copies prove nothing and hide
nothing; c(e, t) must reach ``support``, since a term seen once beside an entity
stood there by chance as often as not. Terms are lower-cased words of three
letters or more outside protected spans.

Everything is built-in expressions. Lines are shuffled as text once, after each
task has dropped its own repeats; the counts of terms are pre-aggregated to one
row per term and task. A common entity or term is pre-aggregated before each
shuffle, and its joins are split by the skew handling. Broader terms are counted
over the lines of generalised terms only. Revealing terms are found in a line
or a document by a hash table in the plan (an array of buckets), so neither the
lines nor the documents are shuffled for it. More than ``LITERALS`` terms, or
``TABLE_BYTES`` of them, take a pass over the documents per table, and the hits
of the passes are joined with the documents.

Defined cases: a null text counts as empty; without matches the counts are 0,
base_sha256 is that of the empty string and spans are empty; repeated rows are
each returned; entities in fewer than ``support`` different lines have no
terms; an empty table gives no rows. ``sanitise`` keeps a null text null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import spans as S

#: The base patterns. Possessive repeats and anchors at the start of a run (or the end of the last
#: match) find the same leftmost matches in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "general": "[TERM]", "removed": ""}
TERM = r"\p{L}{3,}"

SUPPORT = 2
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
Z = 1.0
BROADER_SHARE = 0.8
#: Most revealing terms that are held in the plan, their bytes, and the buckets for each.
LITERALS = 1 << 18
TABLE_BYTES = 8 << 20
BUCKETS = 2


def _luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(d: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    ds = F.transform(F.split(F.reverse(number), ""), lambda c, i: step(c.cast("int"), i))
    return F.aggregate(ds, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":                                       # every part at most 255, leading zeros allowed
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    number = S.digits(match)
    if kind == "card":
        return F.when(F.char_length(number).between(13, 19), _luhn(number)).otherwise(F.lit(False))
    return F.char_length(number).between(9, 15)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind; a cheap test leaves out texts that cannot match."""
    may = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike(r"[0-9]\.[0-9]"),
           "card": text.rlike(r"[0-9][\x20-]?[0-9]")}
    return {k: F.when(may[k], _checked(text, k)).otherwise(S.none()) for k in KINDS}


def _checked(text: Column, kind: str) -> Column:
    return F.filter(S.matches(text, PATTERNS[kind]), lambda x: _valid(kind, x["m"]))


def _entities() -> Column:
    """Distinct "kind:value" of the base span columns, values normalised."""
    def named(kind):
        clean = (lambda m: F.lower(m)) if kind in ("email", "ip") else S.digits
        return F.transform(kind, lambda x: F.concat(F.lit(f"{kind}:"), clean(x["m"])))
    return F.array_distinct(F.concat(*[named(k) for k in KINDS]))


def _with_spans(rows: DataFrame) -> DataFrame:
    """rows (with text ``t``) and the base spans and entities."""
    rows = rows.select("*", *[c.alias(k) for k, c in base_spans(F.col("t")).items()])
    return rows.select("*", _entities().alias("entities"))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _outside(text: Column) -> Column:
    """text without its addresses, the only base spans that hold letters."""
    return F.when(text.contains("@"), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)


def _wilson(hits: Column, of: Column, z: float) -> Column:
    """Lower Wilson bound of the share hits / of."""
    p, z2 = hits / of, z * z
    return (p + z2 / (2 * of) - z * F.sqrt(p * (1 - p) / of + z2 / (4 * of * of))) / (1 + z2 / of)


def _line_terms() -> Column:
    return F.array_distinct(_terms(_outside(F.col("t"))))


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """Column ``t``: every line of every text."""
    return docs.select(F.col(text).alias("t")).where("t IS NOT NULL").select(F.explode(F.split("t", "\n")).alias("t"))


def _revealing(docs: DataFrame, text: str, support: int, generalise_at: float, remove_at: float,
               z: float) -> tuple[DataFrame, DataFrame]:
    """(entity, term, disclosure, removed) of the revealing terms, and (term, c_t) of all terms."""
    checkpoint_dir(docs.sparkSession)
    bearing = _with_spans(docs.select(F.col(text).alias("t")).where("t IS NOT NULL")).where(F.size("entities") > 0)
    lines = _with_spans(_lines(bearing, "t")).where(F.size("entities") > 0).select("t", "entities").distinct()
    # the empty term stands in every line: its counts are N and c(e)
    terms = F.array_append(_line_terms(), F.lit(""))
    pairs = (lines.select(F.explode("entities").alias("entity"), terms.alias("terms"))
             .select("entity", F.explode("terms").alias("term")).groupBy("entity", "term")
             .agg(F.count(F.lit(1)).alias("c_et")).where(F.col("c_et") >= support).checkpoint())
    corpus = (_lines(docs, text).distinct().select(F.explode(terms).alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).alias("c_t")).checkpoint())
    whole = corpus.where("term = ''").first()
    n = F.lit(float(whole["c_t"] if whole else 0))
    entities = pairs.where("term = ''").select("entity", F.col("c_et").alias("c_e")).where(n > F.col("c_e"))
    joined = pairs.where("term <> ''").join(entities, "entity").join(corpus, "term")
    told = F.ln(n / F.col("c_e"))
    score = 1 + F.ln(F.col("c_et") / F.col("c_t")) / told
    bound = 1 + F.ln(_wilson(F.col("c_et"), F.col("c_t"), z)) / told
    found = joined.where(bound >= generalise_at).select("entity", "term", score.alias("disclosure"))
    return found.withColumn("removed", F.col("disclosure") >= remove_at), corpus


def disclosures(docs: DataFrame, *, text: str = "text", support: int = SUPPORT, generalise_at: float = GENERALISE_AT,
                remove_at: float = REMOVE_AT, z: float = Z) -> DataFrame:
    """(entity, term, disclosure, removed) of all revealing terms."""
    return _revealing(docs, text, support, generalise_at, remove_at, z)[0]


def _tables(acts: DataFrame) -> tuple[int, list[DataFrame]]:
    """The number of terms of acts (term, put, removed), and acts cut into parts of at most about TABLE_BYTES."""
    size = acts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term") + F.octet_length("put") + 4).alias("b")).first()
    parts = -(-(size["b"] or 0) // TABLE_BYTES)
    if parts < 2:
        return size["n"], [acts]
    part = F.pmod(F.xxhash64(F.lit(1), "term"), F.lit(parts))
    return size["n"], [acts.where(part == i) for i in range(parts)]


def _look_up(acts: DataFrame):
    """Function of an array of words: the rows of acts (term, put, removed) whose term is one of them.

    The rows go into an array of buckets by hash, each a text of its rows. Terms and what is put in their place hold
    no control characters.
    """
    n = max(1, BUCKETS * acts.count())
    row = F.concat(F.lit("\1"), "term", F.lit("\2"), "put", F.lit("\2"), F.col("removed").cast("int").cast("string"))
    cells = [""] * n
    for r in (acts.groupBy(F.pmod(F.xxhash64("term"), F.lit(n)).alias("cell"))
              .agg(F.concat_ws("", F.sort_array(F.collect_list(row))).alias("rows")).collect()):
        cells[r["cell"]] = r["rows"]
    table = F.split(F.lit("\n".join(cells)), "\n")

    def found(words: Column, table: Column) -> Column:
        def cell(x):
            return F.get(table, F.pmod(F.xxhash64(x), F.lit(n)).cast("int"))

        def key(x):
            return F.concat(F.lit("\1"), x, F.lit("\2"))

        def parsed(x):
            return S.let(F.substring_index(F.split_part(cell(x), key(x), F.lit(2)), "\1", 1), lambda rest: F.struct(
                x.alias("term"), F.substring_index(rest, "\2", 1).alias("put"),
                (F.substring_index(rest, "\2", -1) == "1").alias("removed")))
        return F.transform(F.filter(words, lambda x: (cell(x) != "") & F.contains(cell(x), key(x))), parsed)

    return lambda words: S.let(table, lambda t: found(words, t))


def broader_terms(docs: DataFrame, flagged: DataFrame, corpus: DataFrame, *, text: str = "text") -> DataFrame:
    """(term, broader) of the generalised ones of flagged (term, removed) that have a broader term."""
    given = flagged.where("NOT removed").select("term", F.lit("").alias("put"), "removed")
    held = None
    for part in _tables(given)[1]:
        lines = _lines(docs, text).select("t", _line_terms().alias("terms"))
        # explode_outer: no test is pushed down that would cut and look up the words a second time
        own = lines.select("t", "terms", F.explode_outer(_look_up(part)(F.col("terms"))["term"]).alias("term"))
        own = own.where("term IS NOT NULL").select(F.sha2("t", 256).alias("line"), "terms", "term")
        held = own if held is None else held.unionByName(own)
    counts = (held.dropDuplicates(["line", "term"]).select("term", F.explode("terms").alias("broader"))
              .groupBy("term", "broader").agg(F.count(F.lit(1)).alias("c")).checkpoint())
    total = counts.where("term = broader").select("term", F.col("c").alias("c_t"))
    wide = counts.where("term <> broader").join(total, "term").where(F.col("c") >= BROADER_SHARE * F.col("c_t"))
    wide = (wide.join(corpus.select(F.col("term").alias("broader"), F.col("c_t").alias("c_b")), "broader")
            .where("c_b > c_t").join(flagged.select(F.col("term").alias("broader")), "broader", "left_anti"))
    return (wide.groupBy("term").agg(F.min(F.struct("c_b", "broader")).alias("b"))
            .select("term", F.col("b.broader").alias("broader")))


def find(docs: DataFrame, *, text: str = "text", support: int = SUPPORT, generalise_at: float = GENERALISE_AT,
         remove_at: float = REMOVE_AT, z: float = Z) -> DataFrame:
    """docs with the columns ``_pf_<kind>`` of the base kinds, ``_pf_general`` and ``_pf_removed``: arrays of spans.

    The spans of ``_pf_general`` hold the word to put in the term's place.
    """
    found, corpus = _revealing(docs, text, support, generalise_at, remove_at, z)
    flagged = found.groupBy("term").agg(F.max("removed").alias("removed")).checkpoint()
    names = [f"_pf_{k}" for k in [*KINDS, "general", "removed"]]
    body = F.coalesce(F.col(text), F.lit(""))
    spanned = docs.select("*", *[c.alias(f"_pf_{k}") for k, c in base_spans(body).items()])
    if flagged.isEmpty():                                  # no term of the corpus reaches a threshold
        return spanned.select("*", S.none().alias(names[-2]), S.none().alias(names[-1]))
    if not flagged.where("NOT removed").isEmpty():
        flagged = flagged.join(broader_terms(docs, flagged, corpus, text=text), "term", "left")
    else:
        flagged = flagged.withColumn("broader", F.lit(None).cast("string"))
    acts = flagged.select("term", F.when(F.col("removed"), "").otherwise(
        F.coalesce("broader", F.lit(LABELS["general"]))).alias("put"), "removed").checkpoint()
    own = F.array_distinct(_terms(body))
    terms, parts = _tables(acts)
    if len(parts) == 1 and terms <= LITERALS:
        joined = spanned.select("*", _look_up(acts)(own).alias("_pf_acts"))
    else:
        # the terms to act on depend on the text alone
        hits = None
        for part in parts:
            hit = (docs.select(body.alias("t"), F.explode_outer(_look_up(part)(own)).alias("act"))
                   .where("act IS NOT NULL").select(F.sha2("t", 256).alias("_pf_key"), "act").distinct().checkpoint())
            hits = hit if hits is None else hits.unionByName(hit)
        by_text = hits.groupBy("_pf_key").agg(F.collect_list("act").alias("_pf_acts"))
        joined = spanned.withColumn("_pf_key", F.sha2(body, 256)).join(by_text, "_pf_key", "left").drop("_pf_key")
    base = F.concat(*[F.col(f"_pf_{k}") for k in KINDS])

    def of(removed: bool) -> Column:
        acts = F.filter("_pf_acts", lambda a: a["removed"] == removed)
        named = lambda x: F.filter(acts, lambda a: a["term"] == F.lower(x["m"]))

        def pick(base):
            kept = F.filter(S.matches(body, TERM), lambda x: (F.size(named(x)) > 0) & ~F.exists(
                base, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])))
            return F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"),
                                                        F.get(named(x), F.lit(0))["put"].alias("m"))).cast(S.SPAN)
        return F.when(F.size(acts) > 0, S.let(base, pick)).otherwise(S.none())

    return joined.select("*", of(False).alias(names[-2]), of(True).alias(names[-1])).drop("_pf_acts")


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Counts, digest of the base spans and all spans (base kinds, then general, then removed) of every row."""
    found = find(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), **settings)

    def joined(kinds):
        return F.array_join(F.concat(*[S.labelled(F.col(f"_pf_{k}"), k) for k in kinds]), ",")

    return found.select("doc_id", *[F.size(f"_pf_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(KINDS), 256).alias("base_sha256"),
                        joined([*KINDS, "general", "removed"]).alias("spans"))


def sanitise(docs: DataFrame, *, text: str = "text", **settings) -> DataFrame:
    """docs, same columns, with every span replaced; overlapping spans are replaced as one by the first one's label."""
    found = find(docs, text=text, **settings)

    def labelled(kind):
        return F.transform(f"_pf_{kind}", lambda x: F.struct(
            x["s"].alias("s"), (-x["e"]).alias("back"),
            (x["m"] if kind == "general" else F.lit(LABELS[kind])).alias("label")))

    spans = F.sort_array(F.concat(*[labelled(k) for k in LABELS]))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def rebuilt(spans):
        def step(a, x):
            gap = F.substring(F.col(text), (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int"))
            out = F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(gap, x["label"]))).otherwise(a["out"])
            return F.struct(F.greatest(a["at"], -x["back"]).alias("at"), out.alias("out"))
        return F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(
            F.col(text), (a["at"] + 1).cast("int"), F.char_length(F.col(text)))))

    clean = S.let(spans, lambda s: F.when(F.size(s) > 0, rebuilt(s)).otherwise(F.col(text)))
    return found.withColumn(text, clean).select(*docs.columns)
