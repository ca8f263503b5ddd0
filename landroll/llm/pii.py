"""Personal data: seed expressions, then bootstrapped contextual extraction.

Seeds are the spans that four fixed expressions (with their checks) find, and
keys and other secrets: runs of letters and digits that alphabet and entropy
tell from words and numbers.  The
words of the text left of a seed induce lexical patterns: the last two words,
and a label (a last word that ends in ``:``, ``=`` or ``#``), numbers in them
all alike, quotes and brackets that open the seed left out.  Other tokens that hold a digit, ``@`` or ``[at]`` and stand behind
the same words are further instances of a pattern; neighbouring groups of
digits are one token.  On the bipartite graph of patterns and instances two scores are
iterated: a pattern's confidence for a kind is the sum of its instances'
scores over one more than their number; an instance that is no seed scores
1 - product of (1 - confidence) over its patterns.  A pattern enters the graph
in the round in which its seeds and confident instances sum up to enough, so
what was found supports further patterns.  Rounds end when no confidence rises
any more.  Patterns of enough confidence mark the tokens behind them, as spans
of their kind.

Everything is DataFrame functions: regular expressions, arrays, windows, joins
and aggregates.  Positions are running sums over the gaps and matches of one
document; only candidates, never texts, are shuffled to find spans.  The
patterns are linear-time (possessive, anchored at token starts) and need no
deep recursion, so texts may be long.

Defined results: a null text is empty; rows that repeat a doc_id are judged by
their own texts, equal rows alike; a null doc_id is an id like any other; an
empty table gives an empty result; other columns are ignored (or kept by
:func:`redacted`).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
SEEDS = (*KINDS, "secret")      # the kinds that seeds, and so spans, can have
TOKENS = len(SEEDS)             # the kind number of candidates that are no seed

# What each kind looks like.  (?:\G|(?<!...)) starts a match at
# the end of the last one or at the start of a run: no other start can match.
EXPRESSIONS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![\p{L}\p{N}])(?=[A-Za-z]*+[0-9]|AKIA)[A-Za-z0-9]{20,}+(?!\p{L}|\p{N})",
}
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
         "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9]{20}"}
_AT = r"[(\[{](?i:at)[)\]}]"
_KEY_ID = r"^AKIA[0-9A-Z]{16}$"     # a common cloud's access key ids, which need not hold a digit
TOKEN_NEEDS = rf"[0-9@]|{_AT}"
TEXT_NEEDS = TOKEN_NEEDS + "|AKIA"
TOKEN = (r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D0-9@]*+[0-9@]|[^\x20\x09-\x0D]*?" + _AT + r")"
         r"[^\x20\x09-\x0D]*+")
# A token that ends in a group of digits (after a label or signs at most), and one that carries it on.
GROUPS_BEGIN = r"^(?:[^0-9@]*[^\p{L}0-9@])?[0-9]++(?:[().+/-]++[0-9]++)*+[)\]]?$"
GROUPS_GO_ON = r"^[(\[]?[0-9]++(?:[().+/-]++[0-9]++)*+[)\]]?"
GROUPS_LAST = GROUPS_GO_ON + r"[^\p{L}\p{N}@]*$"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

MIN_SEEDS = 3           # summed score of different seeds and confident instances that a pattern needs
MIN_CONFIDENCE = 0.7
MIN_RISE = 0.001        # of a pattern's confidence for which there is a further round
MIN_DIGITS = 4          # of a found token without @
MIN_SECRET = 8          # characters of a found secret, letters and digits among them
MIN_BITS = 3.0          # entropy of a character of a secret that is a seed
MIN_TURNS = 4           # of it from letters to digits and back
CONTEXT_CHARS = 100     # of the text before a candidate in which its words are looked for
CHUNK = 4096            # characters of the chunks in which a text is cut to replace its spans


def _passes(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        n = F.length(digits)

        def step(total: Column, i: Column) -> Column:
            d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
            return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

        luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0
        return F.when(n.between(13, 19), luhn).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "secret":
        return m.rlike(_KEY_ID) | (
            (F.regexp_count(m, F.lit("[A-Za-z][0-9]|[0-9](?=[A-Za-z])")) >= MIN_TURNS) & (_bits(m) >= MIN_BITS))
    return F.lit(True)


def _bits(m: Column) -> Column:
    """Entropy of the characters of a run of ASCII letters and digits, in bits."""
    n = F.length(m).cast("double")

    def add(total: Column, c: Column) -> Column:
        share = (n - F.length(F.replace(m, c, F.lit("")))) / n
        return total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)

    alphabet = F.array(*[F.lit(c) for c in string.ascii_letters + string.digits])
    return F.aggregate(alphabet, F.lit(0.0), add)


def _candidates(number: int, expression: str, needs: str) -> Column:
    """array of (kind, i, gap, m, left) of the matches of one expression in column text."""
    text = F.col("text")
    gaps, matches = F.split(text, expression, -1), F.regexp_extract_all(text, F.lit(expression), F.lit(0))

    def tail(part: Column) -> Column:
        return F.right(part, F.lit(CONTEXT_CHARS))

    def rows(pairs: Column) -> Column:
        def row(pair: Column, i: Column) -> Column:
            # A match and its gap have two characters or more, a token that begins the text excepted.
            near = F.least(i, F.lit(CONTEXT_CHARS // 2 + 1))
            before = F.transform(F.slice(pairs, i - near + 1, near),
                                 lambda p: F.concat(tail(p["gap"]), tail(p["m"])))
            return F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(pair["gap"]).alias("gap"),
                            pair["m"].alias("m"),
                            tail(F.concat(F.array_join(before, ""), tail(pair["gap"]))).alias("left"))
        return F.transform(pairs, row)

    # There is one gap more than matches: the text after the last.  An array of one binds the pairs for all rows.
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("m"))
    zipped = F.transform(F.array(pairs), rows)[0]
    empty = "cast(array() as array<struct<kind: int, i: int, gap: int, m: string, left: string>>)"
    return F.when(text.rlike(needs), zipped).otherwise(F.expr(empty))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, kind, start, end, m, left, base, seed): seeds and tokens, with code point positions.

    kind is that of ``SEEDS`` for a match that passes its check, base if it is
    one of ``KINDS``; a secret touches no base span.  Kind ``TOKENS`` are tokens
    that touch no seed, neighbouring groups of digits joined.  left is the text
    before it, up to ``CONTEXT_CHARS``.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("mark", F.xxhash64("text"))
    found = F.concat(*[_candidates(k, EXPRESSIONS[kind], NEEDS[kind]) for k, kind in enumerate(SEEDS)],
                     _candidates(TOKENS, TOKEN, TOKEN_NEEDS))
    rows = (texts.where(F.col("text").rlike(TEXT_NEEDS)).select("doc_id", "mark", F.explode(found).alias("c"))
            .select("doc_id", "mark", "c.*"))
    # Equal rows of the table give equal candidates: one set will do.  A document's candidates meet in one task.
    rows = (rows.groupBy("doc_id", "mark", "kind", "i").agg(
                F.first("gap").alias("gap"), F.first("m").alias("m"), F.first("left").alias("left"))
            .repartition("doc_id", "mark"))
    line = Window.partitionBy("doc_id", "mark", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    check = F.lit(True)
    for k, kind in enumerate(SEEDS):
        check = F.when(F.col("kind") == k, _passes(kind, F.col("m"))).otherwise(check)
    placed = (rows.withColumn("end", F.sum(F.col("gap") + F.length("m")).over(line))
              .withColumn("start", F.col("end") - F.length("m"))
              .where(check).withColumn("base", F.col("kind") < len(KINDS)))
    # Both frames grow from their first row, so each is one running value: the later rows come from the reversed order.
    document = Window.partitionBy("doc_id", "mark")
    before = document.orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = (document.orderBy(*[F.col(c).desc() for c in ("start", "end", "kind")])
             .rowsBetween(Window.unboundedPreceding, -1))

    def free_of(most: int) -> Column:
        until = F.max(F.when(F.col("kind") < most, F.col("end"))).over(before)
        since = F.min(F.when(F.col("kind") < most, F.col("start"))).over(after)
        return (F.coalesce(until, F.lit(0)) <= F.col("start")) & (F.coalesce(since, F.col("end")) >= F.col("end"))

    kept = (placed.withColumn("of_base", free_of(len(KINDS))).withColumn("of_seeds", free_of(TOKENS))
            .where(F.col("base") | F.col("of_base") & ((F.col("kind") < TOKENS) | F.col("of_seeds")))
            .drop("of_base", "of_seeds"))
    # A token joins the one before it if both are groups of digits with one or two blanks between.
    order = Window.partitionBy("doc_id", "mark", "kind").orderBy("i")
    blanks = F.right("left", F.col("gap"))
    goes_on = ((F.col("kind") == TOKENS) & (F.lag("i").over(order) == F.col("i") - 1)
               & F.col("gap").between(1, 2) & blanks.rlike(r"^[\x20\x09]+$") & F.col("m").rlike(GROUPS_LAST)
               & F.lag("m").over(order).rlike(GROUPS_BEGIN))
    joined = (kept.withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
              .withColumn("first", F.sum((~F.col("goes_on")).cast("int")).over(
                  order.rowsBetween(Window.unboundedPreceding, 0))))
    piece = F.struct("i", F.when(F.col("goes_on"), F.concat(blanks, F.col("m"))).otherwise(F.col("m")).alias("m"))
    return (joined.groupBy("doc_id", "mark", "kind", "first").agg(
                F.min("start").alias("start"), F.max("end").alias("end"),
                F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda x: x["m"]), "").alias("m"),
                F.min_by("left", "i").alias("left"), F.first("base").alias("base"))
            .select("doc_id", "mark", "kind", "start", "end", "m", "left", "base",
                    (F.col("kind") < TOKENS).alias("seed")))


def _with_patterns(rows: DataFrame) -> DataFrame:
    """One row per candidate and pattern; the pattern's words are lower-cased, a number in them is 0."""
    plain = F.regexp_replace(F.regexp_replace(F.lower("left"), r"[^\p{L}\p{N}\x20\x09-\x0D:=#]+$", ""), "[0-9]+", "0")
    words = F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    last, two = F.element_at("words", -1), F.slice("words", -2, 2)
    patterns = F.array(
        F.when(F.size("words") >= 2, F.concat(F.lit("2 "), F.array_join(two, " "))),
        F.when(last.rlike(r"[:=#]$") & (F.length(last) > 1), F.concat(F.lit("1 "), last)))
    return (rows.withColumn("words", words).where(F.size("words") > 0)
            .withColumn("p", F.explode(F.array_compact(patterns))).drop("words", "left"))


def _identifier(m: Column) -> Column:
    """A token without the quotes, brackets and points around it; (555) before more digits keeps its brackets."""
    begun = F.regexp_replace(m, r"^(?:(?!\([0-9]+\)[\x20\x09]*[0-9])[^\p{L}\p{N}+@])++", "")
    return F.regexp_replace(begun, r"[^\p{L}\p{N}]+$", "")


def _plausible(kind: Column, token: Column) -> Column:
    """Whether an identifier can be of the kind at all."""
    secret = (F.length(token) >= MIN_SECRET) & token.rlike("[A-Za-z]") & token.rlike("[0-9]")
    return F.when(kind == 0, token.rlike(rf"@|{_AT}")).when(kind == len(KINDS), secret).otherwise(
        F.length(F.regexp_replace(token, "[^0-9]", "")) >= MIN_DIGITS)


def learn(rows: DataFrame, rounds: int | None = None, min_seeds: int = MIN_SEEDS,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(p, kind, confidence) of the patterns to trust, from candidates with patterns.

    Without ``rounds`` there are as many as raise some confidence by more than
    ``MIN_RISE``.  No confidence ever falls, so they come to an end.
    """
    x = F.lower(F.when(F.col("seed"), F.col("m")).otherwise(_identifier(F.col("m"))))
    edges = staged(rows.select("p", x.alias("x"), F.when(F.col("seed"), F.col("kind")).alias("seed")).distinct(),
                   "pii-edges")
    # A pattern of fewer instances cannot reach the sum, as no instance counts for more than 1.
    n_instances = staged(edges.groupBy("p").agg(F.count_distinct("x").alias("n"))
                         .where(F.col("n") >= min_seeds), "pii-patterns")
    known = edges.where("seed is not null").select("p", "x", F.col("seed").alias("kind"), F.lit(1.0).alias("score"),
                                                   F.lit(True).alias("counts"))
    open_edges = staged(edges.where("seed is null").join(n_instances, "p", "left_semi").select("p", "x"),
                        "pii-open")
    scored, last, done = known, None, 0
    while rounds is None or done < rounds:
        confidence = staged(
            scored.groupBy("p", "kind").agg(F.sum("score").alias("sum"),
                                            F.sum(F.when(F.col("counts"), F.col("score"))).alias("support"))
            .where(F.col("support") >= min_seeds).join(n_instances, "p")
            .select("p", "kind", (F.col("sum") / (F.col("n") + 1)).alias("confidence")), "pii-confidence")
        done += 1
        if rounds is None and not _rises(confidence, last):
            break
        last = confidence
        doubt = F.sum(F.log1p(-F.col("confidence")))
        instances = (open_edges.join(confidence, "p").groupBy("x", "kind")
                     .agg((1 - F.exp(doubt)).alias("score"))
                     .withColumn("counts", (F.col("score") >= min_confidence)
                                 & _plausible(F.col("kind"), F.col("x"))))
        scored = known.unionByName(open_edges.join(instances, "x").select("p", "x", "kind", "score", "counts"))
    return confidence.where(F.col("confidence") >= min_confidence)


def _rises(confidence: DataFrame, last: DataFrame | None) -> bool:
    """Whether some pattern is new or trusted by more than ``MIN_RISE`` above the last round."""
    if last is None:
        return not confidence.isEmpty()
    before = last.select("p", "kind", F.col("confidence").alias("last"))
    return not (confidence.join(before, ["p", "kind"], "left")
                .where(F.col("confidence") > F.coalesce("last", F.lit(-1.0)) + MIN_RISE).isEmpty())


def spans(docs: DataFrame, rounds: int | None = None, min_seeds: int = MIN_SEEDS,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(doc_id, mark, kind, start, end, base) of all spans; kind is a number into ``SEEDS``.

    mark is the hash of the text; equal rows of the table share their spans.
    """
    rows = staged(candidates(docs), "pii-candidates")
    behind = _with_patterns(rows)
    trusted = learn(behind, rounds, min_seeds, min_confidence)
    token = _identifier(F.col("m"))
    unseen = (behind.where(~F.col("seed")).drop("kind").join(trusted, "p")
              .groupBy("doc_id", "mark", "start", "m")
              .agg(F.max(F.struct("confidence", (-F.col("kind")).alias("order"))).alias("best"))
              .select("doc_id", "mark", F.col("start").alias("at"), "m", token.alias("token"),
                      (-F.col("best.order")).alias("kind"))
              .where(_plausible(F.col("kind"), F.col("token")))
              .withColumn("start", F.col("at") + F.instr("m", F.col("token")) - 1)
              .select("doc_id", "mark", "kind", "start", (F.col("start") + F.length("token")).alias("end"),
                      F.lit(False).alias("base")))
    return rows.where("seed").select("doc_id", "mark", "kind", "start", "end", "base").unionByName(unseen)


def document_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): array of (kind, start, end, base) by kind, then start, of documents that have any."""
    return staged(spans(docs).groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "end", "base"))).alias("spans")), "pii-spans")


def document_cuts(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): the stretches to replace, as array of (start, kind, since).

    Spans that overlap are one stretch, of the kind of the first; since is the
    end of the stretch before.  The last entry has no kind and is the text's rest.
    """
    found = spans(docs)
    document = Window.partitionBy("doc_id", "mark").orderBy("start", "end", "kind")
    since = F.max("end").over(document.rowsBetween(Window.unboundedPreceding, -1))
    opens = (found.withColumn("since", F.coalesce(since, F.lit(0).cast("long")))
             .withColumn("opens", F.col("start") >= F.col("since")))
    cuts = F.collect_list(F.when(F.col("opens"), F.struct("start", "kind", "since")))
    rest = F.struct(F.lit(None).cast("long").alias("start"), F.lit(None).cast("int").alias("kind"),
                    F.max("end").alias("since"))
    return staged(opens.groupBy("doc_id", "mark").agg(
        F.concat(F.sort_array(cuts), F.array(rest)).alias("spans")), "pii-cuts")


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (doc_id, __mark and others) with __spans, empty if there are none.

    A merge join whatever the size: the spans are not broadcast.
    """
    keys = found.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__found_mark"),
                        F.col("spans").alias("__found"))
    return (rows.join(keys.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id"))
                      & (F.col("__mark") == F.col("__found_mark")), "left")
            .withColumn("__spans", F.coalesce("__found", F.array().cast(found.schema["spans"].dataType))))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every document."""
    ids = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("__mark"))
    return _joined(ids, document_spans(docs)).select("doc_id", F.col("__spans").alias("spans"))


def written(spans_column: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    name = F.array(*[F.lit(k) for k in SEEDS])
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind, as in <EMAIL>; n_chars, if there, follows.

    The text is cut into chunks of ``CHUNK`` characters first, and each piece
    from its chunks: the work grows with text and spans, not with their product.
    """
    tag = F.array(*[F.lit(f"<{k.upper()}>") for k in SEEDS])

    def clean(chunks: Column) -> Column:
        def piece(cut: Column) -> Column:
            first = F.floor(cut["since"] / CHUNK).cast("int")
            # The chunk of the piece's last character; of an empty piece, its own.
            until = F.coalesce(cut["start"], F.col("__n"))
            last = F.greatest(first, F.floor((until - 1) / CHUNK).cast("int"))
            near = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
            kept = F.substring(near, (cut["since"] - first * CHUNK + 1).cast("int"), (until - cut["since"]).cast("int"))
            return F.concat(kept, F.coalesce(F.get(tag, cut["kind"]), F.lit("")))
        return F.array_join(F.transform("__spans", piece), "")

    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    marked = docs.withColumn("__mark", F.xxhash64(text_or_empty()))
    out = (_joined(marked, document_cuts(docs)).withColumn("__n", F.length("text").cast("long"))
           .withColumn("__clean", F.when(F.size("__spans") > 0, F.transform(F.array(chunks), clean)[0])
                       .otherwise(F.col("text"))))
    made = {"text": F.col("__clean"), "n_chars": F.length("__clean").cast("long")}
    return out.select(*[made.get(c, F.col(c)).alias(c) for c in docs.columns])
