"""Personal data: base patterns, and information-theoretic sanitisation of what reveals them.

Base spans (email, ip, card, phone) are leftmost non-overlapping matches of fixed patterns;
matches that fail a check are dropped. Positions come from the lengths of matches and of the
pieces between them, so they are code points and need no Python.

Each distinct value found is a protected entity e. A term t near it (within CONTEXT
characters) reveals it as far as t leaves little to learn about e: with counts over all
documents, -log2 P(e|t) bits are left, where

    disclosure(t, e) = P(e|t) = n(t,e) / n(t),

which is 1 when t occurs beside e alone. Every term that stands near e and informs about it,
P(e|t) > P(e) = n(e) / N, is rated, in however few texts e stands. Terms with a disclosure of
THRESHOLD or more are generalised: all their occurrences, in whatever text and however far
from e, become spans of kind ``term``. The rule is a ratio of counts, so it is as strict in a
large table as in a small one: a term of one text beside e and of one without is never marked.
``sanitise`` replaces base spans by their kind and these terms by a placeholder.

Only DataFrame functions are used. Counting is by partial aggregation; contexts are rows, so
an entity in a third of all documents is never gathered in one task. Pairs meet the counts of
their terms and entities in joins that broadcast the few keys with a large share of the pairs.
Texts don't move: a Bloom filter of the disclosing terms, of a fixed size, says in the scan
which texts may hold one, and only the words that pass it are joined with the terms. Where
the terms are too many to broadcast, words of many texts are told apart by a list of their own
first, so that none of them is a key of the shuffled join.

Edge cases: null and empty texts have no spans; copies with other ids count as documents;
repeated rows (one id, one text) count once near an entity and each time elsewhere, so they
never add terms, and get equal results; rows are matched by doc_id and text; an empty table gives no rows; other
columns are ignored by ``find_personal_data`` and kept by ``sanitise``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import native
from .textkit import stored, table

CONTEXT = 80
THRESHOLD = 0.6
#: Keys with more than one in so many rows are broadcast; there are fewer of them than that.
SHARE = 1000
#: The filter has two to this many bits, whatever the number of terms (512 kB).
FILTER_BITS = 22

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns below match what the plain ones do. Possessive repeats and looking behind keep
# them linear on long runs: a match can only begin where its run begins or a match has ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Runs with fewer than 13 digits would be dropped anyway.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}]{3,}"
#: Stands for the letters of e-mail addresses; a word of a text that has it is no term.
MASK = "\ua7fa"
#: Characters in a piece that sides are taken from; more than CONTEXT.
PIECE_SIZE = 1024
#: Items whose positions are summed in one array.
BLOCK = 256
#: These cover a text, and no run of letters is in two of them.
PIECE = r"(?s).{1,400}+[\p{L}]*+"

_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column) -> Column:
    """An array in blocks of BLOCK items, one at least."""
    last = F.greatest(F.floor((F.size(items) - 1) / BLOCK).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * BLOCK + 1, BLOCK))


def matches(text: Column, kind: str, pattern: str) -> Column:
    """All matches with their positions.

    Positions are summed block by block: appending copies an array, so one array for all
    matches of a long text would take quadratic time.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["value"]), F.lit(0))
        found = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["value"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], found)).alias("out"))

    def within(at: Column, items: Column) -> Column:
        return F.aggregate(items, F.struct(at.alias("at"), F.array().cast(_SPAN).alias("out")), step)

    def block(acc: Column, items: Column) -> Column:
        return _bind(within(acc["at"], items), lambda q: F.struct(q["at"].alias("at"), F.array_append(acc["parts"], q["out"]).alias("parts")))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("parts"))
    many = lambda p: F.flatten(F.aggregate(_blocks(p), zero, block, lambda acc: acc["parts"]))
    return _bind(pairs, lambda p: F.when(F.size(p) <= BLOCK, within(F.lit(0), p)["out"]).otherwise(many(p)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    backwards = F.split(F.reverse(_digits(value)), "")
    valued = F.transform(F.filter(backwards, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(valued, F.lit(0), lambda a, d: a + d) % 10 == 0


def _low_parts(value: Column) -> Column:
    def small(part: Column) -> Column:
        p = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255")

    return F.forall(F.split(value, r"\."), small)


def base_spans(text: Column) -> Column:
    """The base spans of a text: by kind as listed, then by start."""
    none = F.array().cast(_SPAN)

    def found(kind: str, pattern: str, possible: Column, keep: Callable[[Column], Column] | None = None) -> Column:
        all_of = matches(text, kind, pattern)
        if keep is not None:
            all_of = F.filter(all_of, keep)
        return F.when(possible, all_of).otherwise(none)

    def card(x: Column) -> Column:
        return F.length(_digits(x["value"])).between(13, 19) & _luhn(x["value"])

    def phone(x: Column) -> Column:
        return F.length(_digits(x["value"])).between(9, 15)

    return F.concat(
        found("email", EMAIL, F.contains(text, F.lit("@"))),
        found("ip", IP, F.regexp_like(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]")), lambda x: _low_parts(x["value"])),
        found("card", CARD, F.regexp_like(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}")), card),
        found("phone", PHONE, F.contains(text, F.lit("+")), phone),
    )


def masked(text: Column) -> Column:
    """The text with the letters of its e-mail addresses, the only base spans that have any,
    replaced by MASK: a word that shares a letter with a base span has a MASK in it."""
    pairs = F.arrays_zip(F.split(text, EMAIL, -1).alias("gap"), F.regexp_extract_all(text, F.lit(EMAIL), 0).alias("value"))
    hidden = F.transform(pairs, lambda x: F.concat(x["gap"], F.regexp_replace(F.coalesce(x["value"], F.lit("")), r"\p{L}", MASK)))
    return F.when(F.contains(text, F.lit("@")), F.array_join(hidden, "")).otherwise(text)


def _contexts(text: Column, spans: Column) -> Column:
    """For each span its entity and the distinct words of the (masked) text on either side,
    without words that are cut or share a letter with a base span.

    Sides are taken from pieces of the text, as a substring costs what stands before it.
    """

    def part(pieces: Column, begin: Column, length: Column) -> Column:
        k = F.floor(begin / PIECE_SIZE).cast("int")
        return F.concat(F.get(pieces, k), F.coalesce(F.get(pieces, k + 1), F.lit(""))).substr(begin - k * PIECE_SIZE + 1, length)

    def near(pieces: Column, x: Column) -> Column:
        begin = F.greatest(x["start"] - CONTEXT, F.lit(0))
        left = F.coalesce(part(pieces, begin, x["start"] - begin), F.lit(""))
        cut = F.when(begin > 0, F.regexp_replace(left, r"^\S+", "")).otherwise(left)
        right = F.coalesce(part(pieces, x["end"], F.lit(CONTEXT)), F.lit(""))
        whole = F.when(F.length(right) == CONTEXT, F.regexp_replace(right, r"\S+$", "")).otherwise(right)
        both = F.concat(cut, F.lit(" | "), whole)
        clear = F.filter(F.regexp_extract_all(both, F.lit(TERM), 0), lambda w: ~F.contains(w, F.lit(MASK)))
        return F.struct(F.concat_ws(":", x["kind"], F.lower(x["value"])).alias("entity"), F.array_distinct(F.transform(clear, F.lower)).alias("terms"))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_SIZE}}}+"), 0)
    return _bind(pieces, lambda p: F.transform(spans, lambda x: near(p, x)))


def _vocabulary(text: Column) -> Column:
    return F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), 0)), F.lower))


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash"))


def _with_counts(pairs: DataFrame, n_pairs: int, counts: DataFrame, key: str) -> DataFrame:
    """``pairs`` joined with ``counts`` by ``key``, whose frequent values are not sent to one task."""
    often = stored(pairs.groupBy(key).agg(F.count("*").alias("share")).where(F.col("share") * SHARE > n_pairs).select(key), "often")
    few = pairs.join(F.broadcast(often), key, "left_anti").join(counts, key)
    many = pairs.join(F.broadcast(counts.join(F.broadcast(often), key, "left_semi")), key)
    return few.unionByName(many)


def _word_bits(term: Column) -> list[tuple[Column, Column]]:
    """The two (word, bit) places of a term in the filter."""
    h = F.xxhash64(term)
    places = [h.bitwiseAND(2**FILTER_BITS - 1), F.shiftrightunsigned(h, FILTER_BITS).bitwiseAND(2**FILTER_BITS - 1)]
    return [(F.shiftright(p, 6).cast("int"), p.bitwiseAND(63).cast("int")) for p in places]


def _filter(terms: DataFrame) -> DataFrame:
    """A Bloom filter of ``terms``: one row with ``bits``, an array of 2 ** FILTER_BITS / 64 longs."""
    places = F.array(*(F.struct(word.alias("word"), bit.alias("bit")) for word, bit in _word_bits(F.col("term"))))
    rows = terms.select(F.explode(places).alias("p")).select("p.word", F.expr("shiftleft(1L, p.bit)").alias("bits"))
    none = terms.sparkSession.range(2**FILTER_BITS // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = rows.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return stored(words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits")), "filter")


def _passes(bits: Column, word: Column) -> Column:
    (w0, b0), (w1, b1) = _word_bits(word)
    return (F.getbit(F.get(bits, w0), b0) == 1) & (F.getbit(F.get(bits, w1), b1) == 1)


def _may_be(terms: DataFrame) -> Callable[[Column], Column]:
    """Whether a word may be one of ``terms``, with the filter as a constant: for plans that hold it
    once or twice, as each mention of it is printed with the plan."""
    (bits,) = _filter(terms).first()
    return partial(_passes, F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>"))


def term_counts(docs: DataFrame, nearby: DataFrame, total: int) -> DataFrame:
    """(term, n_t, near, frequent) of the words near entities, and of those in more than one of
    SHARE of the ``total`` texts: at most SHARE times as many as a text has on average."""
    wanted = stored(nearby.where("term is not null").select("term").distinct(), "terms").withColumn("near", F.lit(True))
    # Lower-cased one by one, as the terms near an entity are: a letter may become two.
    seen = docs.select(F.explode(_vocabulary(F.col("text"))).alias("term"))
    # Summed before the join: each task sends a term once, and the join's size is the vocabulary's.
    counts = seen.groupBy("term").agg(F.count("*").alias("n_t")).join(wanted, "term", "left")
    frequent = F.col("n_t") * SHARE > total
    return stored(counts.select("term", "n_t", F.coalesce("near", F.lit(False)).alias("near"), frequent.alias("frequent")).where("near or frequent"), "frequencies")


def disclosing_terms(nearby: DataFrame, counts: DataFrame, total: int, threshold: float = THRESHOLD) -> DataFrame:
    """(entity, term, disclosure) of the terms that reveal an entity.

    ``nearby``: entity, term (null where none stands near), doc_id, text_hash; ``counts``: of
    ``term_counts``; ``total``: the number of documents.
    """
    n_te = stored(nearby.where("term is not null").select("entity", "term", "doc_id", "text_hash").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_te")), "pairs")
    n_e = nearby.select("entity", "text_hash", "doc_id").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    n_pairs = n_te.count()
    rated = _with_counts(_with_counts(n_te, n_pairs, stored(n_e, "entities"), "entity"), n_pairs, counts.where("near").select("term", "n_t"), "term")
    informs = F.col("n_te") * F.lit(total) > F.col("n_t") * F.col("n_e")
    rated = rated.where(informs).withColumn("disclosure", F.col("n_te") / F.col("n_t"))
    return rated.where(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def _only(words: DataFrame, terms: DataFrame, n_terms: int, counts: DataFrame) -> DataFrame:
    """The rows of ``words`` whose term is one of ``terms``, which ``counts`` has."""
    if n_terms <= native.BROADCAST_ROWS:
        return words.join(F.broadcast(terms), "term", "left_semi")
    frequent = counts.where("frequent").select("term")
    rare = words.join(F.broadcast(frequent), "term", "left_anti").join(terms, "term", "left_semi")
    often = stored(frequent.join(terms, "term", "left_semi"), "often")
    return rare.unionByName(words.join(F.broadcast(often), "term", "left_semi")) if often.count() else rare


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, base and terms (arrays of spans) of every document."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    found = texts.withColumn("base", base_spans(F.col("text")))
    contexts = F.when(F.size("base") > 0, _contexts(masked(F.col("text")), F.col("base")))
    found = stored(found.select("doc_id", "text_hash", "base", contexts.alias("near")), "spans")
    total = found.count()

    sides = found.where(F.size("base") > 0).select("doc_id", "text_hash", F.explode("near").alias("n"))
    words = sides.select("doc_id", "text_hash", "n.entity", F.explode_outer("n.terms").alias("term"))
    words = stored(words, "nearby")

    counts = term_counts(texts, words, total)
    revealing = stored(disclosing_terms(words, counts, total, threshold).select("term").distinct(), "revealing")
    # A subquery's value: the plan, which Spark prints and sends many times, holds its name only.
    bits, filtered = F.col("bits"), _filter(revealing).scalar()
    # Positions cost far more than presence, and few texts hold any of these terms.
    vocabulary = F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), 0))
    held = texts.withColumn("bits", filtered).where(F.exists(vocabulary, lambda w: _passes(bits, F.lower(w)))).drop("bits")
    pieces = held.select("doc_id", "text_hash", F.explode(matches(masked(F.col("text")), "piece", PIECE)).alias("p"))
    possible = F.filter(matches(F.col("p.value"), "term", TERM), lambda m: _passes(bits, F.lower(m["value"])) & ~F.contains(m["value"], F.lit(MASK)))
    tokens = pieces.withColumn("bits", filtered).select("doc_id", "text_hash", F.col("p.start").alias("at"), possible.alias("m"))
    tokens = tokens.select("doc_id", "text_hash", "at", F.explode("m").alias("m"))
    start, end = F.col("at") + F.col("m.start"), F.col("at") + F.col("m.end")
    tokens = tokens.select("doc_id", "text_hash", F.lower("m.value").alias("term"), start.alias("start"), end.alias("end"))
    spans = _only(tokens, revealing, revealing.count(), counts)
    listed = spans.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", "term"))).alias("terms")
    )  # bounded by the text: one entry for each of its words
    b, t = found.select("doc_id", "text_hash", "base").alias("b"), listed.alias("t")
    joined = b.join(t, _same("b", "t"), "left")
    terms = F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,term:string>>"))
    terms = F.transform(terms, lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["term"].alias("value")))
    return joined.select("b.doc_id", "b.text_hash", "base", terms.alias("terms"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with their texts sanitised; a null text stays null, other columns are kept.

    Where spans overlap, the one that begins first wins, and of those the longest.
    """
    found = find_personal_data(docs, threshold)
    found = found.where((F.size("base") > 0) | (F.size("terms") > 0)).dropDuplicates(["doc_id", "text_hash"])
    ordered = F.array_sort(F.transform(F.concat("base", "terms"), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))
    changes = found.select("doc_id", "text_hash", ordered.alias("cuts")).alias("c")
    # The input's own names, whatever they are, stay out of the way.
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (F.col(f"d.{names[docs.columns.index(c)]}") for c in ("doc_id", "text"))
    rows = docs.toDF(*names).alias("d")
    same = doc_id.eqNullSafe(F.col("c.doc_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("c.text_hash"))

    def step(acc: Column, x: Column, rest: Column, origin: Column) -> Column:
        """``rest`` is the text from ``origin`` on; what stands between cuts is taken from it."""
        covered = x["start"] < acc["at"]
        before = rest.substr(acc["at"] - origin + 1, x["start"] - acc["at"])
        put = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
        parts = F.when(covered, acc["parts"]).otherwise(F.concat(acc["parts"], F.array(before, put)))
        return F.struct(F.when(covered, acc["at"]).otherwise(-x["back"]).alias("at"), parts.alias("parts"))

    none = F.array().cast("array<string>")

    def block(acc: Column, cuts: Column) -> Column:
        """Cuts of one block, in the stretch of text up to the last of them: a substring costs
        what stands before it, so it's taken from that stretch."""
        upto = F.greatest(F.coalesce(F.element_at(F.slice(cuts, -1, 1), 1)["start"], F.lit(0)) - acc["at"], F.lit(0))
        stretch = acc["rest"].substr(F.lit(1), upto)

        def inside(t: Column) -> Column:
            zero = F.struct(acc["at"].alias("at"), none.alias("parts"))
            return F.aggregate(cuts, zero, lambda a, x: step(a, x, t, acc["at"]))

        def result(q: Column) -> Column:
            rest = acc["rest"].substr(q["at"] - acc["at"] + 1, F.lit(2**31 - 1))
            return F.struct(q["at"].alias("at"), rest.alias("rest"), F.array_append(acc["parts"], F.array_join(q["parts"], "")).alias("parts"))

        return _bind(_bind(stretch, inside), result)

    zero = F.struct(F.lit(0).alias("at"), text.alias("rest"), none.alias("parts"))
    cuts = F.when(F.size("cuts") > 0, F.col("cuts")).otherwise(F.array().cast("array<struct<start:int,back:int,kind:string>>"))
    new = F.aggregate(_blocks(cuts), zero, block, lambda a: F.concat(F.array_join(a["parts"], ""), a["rest"]))
    clean = F.when(F.col("c.cuts").isNull() | text.isNull(), text).otherwise(new)
    joined = rows.join(changes, same, "left")
    out = joined.select(*(clean.alias(n) if c == "text" else F.col(f"d.{n}") for n, c in zip(names, docs.columns, strict=True)))
    return out.toDF(*docs.columns)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(number(k) for k in KINDS[:4]), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "terms")).alias("spans"), F.size("terms").cast("long").alias("n_term"),
    )
