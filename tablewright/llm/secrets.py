"""Operator 2: secret scan with linking of multipart credentials.

Base kinds (``assign``, ``access``, ``hex``) are reported wherever they match.
Weak kinds (a shorter access identifier, a long mixed string, an endpoint) mean
little alone. An interval join within a document finds the parts of other roles
within ``SCOPE`` characters, and a weak candidate is reported only if the parts
that complete a credential are there, apart from it in the text:

* a weak access identifier needs a secret (assign, hex or weak secret),
* a weak secret needs an access identifier (access or weak) or an endpoint,
* an endpoint needs both an access identifier and a secret.

The join has the document and a bucket of positions as its key; a part lies in
the buckets it covers, a candidate asks in the buckets of its scope. It is a
semi-join, so no pairs are made, and a bucket holds no more spans than its width
allows. Everything is built of DataFrame functions.

Cases: null and empty texts have no spans; repeated rows give a row each; an id
may be null; an empty table gives an empty result; other columns are ignored.
Positions are code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import let, written

#: The base patterns.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
#: The weak kinds of this scanner.
WEAK_ACCESS = "A(?:KIA|SIA|ROA|IDA|GPA)[A-Z0-9]{8,}"
WEAK_SECRET = "[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""https?://[^\s"'<>]{4,}"""
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")
ROLES = {"assign": "secret", "access": "access", "hex": "secret", "weak_access": "access", "weak_secret": "secret",
         "endpoint": "endpoint"}
#: Characters between two parts at most, and the width of a bucket.
SCOPE = 200
BUCKET = 512
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """Spans of the matches of a pattern, from the matches and the text between
    them; ``keep`` tells from its text which match counts."""
    number = F.lit(KINDS.index(kind))

    def located(matches: Column) -> Column:
        between = F.split(text, pattern, -1)
        state = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

        def step(state: Column, pair: Column) -> Column:
            start = state["at"] + F.char_length(pair["between"])
            end = start + F.char_length(pair["match"])
            span = F.array(F.struct(start.alias("start"), number.alias("kind"), end.alias("end")))
            wanted = span if keep is None else F.when(keep(pair["match"]), span).otherwise(F.array().cast(SPAN))
            return F.struct(end.alias("at"), F.concat(state["out"], wanted).alias("out"))

        pairs = F.zip_with(matches, F.slice(between, F.lit(1), F.size(matches)),
                           lambda m, b: F.struct(m.alias("match"), b.alias("between")))
        return F.aggregate(pairs, state, step, lambda state: state["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(SPAN)).otherwise(located(m)))


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def candidates(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``base`` and ``weak``, arrays of spans; a weak span overlaps no
    base span, and a weak secret no endpoint: mixed strings are usual in addresses."""
    base = F.concat(
        _spans(text, "assign", ASSIGN, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_LEAST),
        _spans(text, "access", ACCESS), _spans(text, "hex", HEX))
    strong = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    secrets_of = lambda ends: F.concat(ends, F.filter(
        _spans(text, "weak_secret", WEAK_SECRET, strong), lambda s: _apart(s, ends)))
    weak = F.concat(_spans(text, "weak_access", WEAK_ACCESS), let(_spans(text, "endpoint", ENDPOINT), secrets_of))
    both = let(F.struct(base.alias("base"), weak.alias("weak")), lambda x: F.struct(
        F.sort_array(x["base"]).alias("base"), F.filter(x["weak"], lambda w: _apart(w, x["base"])).alias("weak")))
    return df.withColumn("_both", both).select("*", F.col("_both.base").alias("base"), F.col("_both.weak").alias("weak")).drop("_both")


def linked(found: DataFrame, key: str, scope: int = SCOPE) -> DataFrame:
    """(key, start, kind, end) of the weak spans that other parts complete."""
    open_rows = found.where(F.size("weak") > 0)
    role = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLES[k])]), F.col("s.kind"))

    def rows(spans: Column, margin: int) -> DataFrame:
        flat = open_rows.select(key, F.explode(spans).alias("s")).select(
            key, F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"), role.alias("role"))
        low, high = F.floor((F.col("start") - margin) / BUCKET), F.floor((F.col("end") + margin) / BUCKET)
        return flat.withColumn("bucket", F.explode(F.sequence(low, high)))

    ask = rows(F.col("weak"), scope).alias("w")
    part = rows(F.concat("base", "weak"), 0).alias("p")
    # A part is another piece of text: what overlaps a candidate (the address that
    # contains it, or a longer match) does not complete it.
    near = (F.col(f"w.{key}") == F.col(f"p.{key}")) & (F.col("w.bucket") == F.col("p.bucket")) & (
        F.col("p.start") <= F.col("w.end") + scope) & (F.col("w.start") <= F.col("p.end") + scope) & (
        (F.col("p.start") >= F.col("w.end")) | (F.col("p.end") <= F.col("w.start")))

    def has(asking: DataFrame, asked: dict[str, tuple[str, ...]]) -> DataFrame:
        fits = F.lit(False)
        for mine, theirs in asked.items():
            fits = fits | ((F.col("w.role") == mine) & F.col("p.role").isin(*theirs))
        return asking.alias("w").join(part, near & fits, "left_semi").select(f"w.{key}", "w.start", "w.kind", "w.end", "w.role").distinct()

    first = has(ask, {"access": ("secret",), "secret": ("access", "endpoint"), "endpoint": ("access",)})
    ends = first.where("role = 'endpoint'").withColumn("bucket", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / BUCKET), F.floor((F.col("end") + scope) / BUCKET))))
    second = has(ends, {"endpoint": ("secret",)})
    return first.where("role <> 'endpoint'").unionByName(second).select(key, "start", "kind", "end")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of the spans, by start and then kind, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(df: DataFrame, keep: list[str], text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """The columns ``keep`` of every row with ``base`` and ``spans``, arrays of
    struct<start, kind (a place in KINDS), end>: base spans, and all spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = candidates(df.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], text.alias("_text")), F.col("_text"))
    found = written(found.drop("_text").withColumn("_row", F.monotonically_increasing_id()), "spans")
    extra = linked(found, "_row", scope).groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("extra"))
    out = found.join(extra.withColumnRenamed("_row", "_at"), F.col("_row") == F.col("_at"), "left")
    spans = F.sort_array(F.concat("base", F.coalesce("extra", F.array().cast(SPAN))))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "base", spans.alias("spans"))


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``df`` with every reported span of the text replaced by ``mark``. Rows
    without any candidate go through untouched and unshuffled; the spans of the
    others follow from the text alone and are joined to it by its hash."""
    maybe = F.coalesce(F.col(text_col).rlike("|".join((ASSIGN, ACCESS, HEX, WEAK_ACCESS, WEAK_SECRET))), F.lit(False))
    key = F.sha2(F.col(text_col), 256)
    some = df.where(maybe)
    spans = scan(some.select(key.alias("_key"), text_col), ["_key"], text_col, scope).where(F.size("spans") > 0)
    taken = {c.lower() for c in df.columns}
    own, there, found = (next(n for k in range(len(taken) + 1) if (n := f"_{name}{k}") not in taken) for name in ("own", "there", "found"))
    spans = spans.groupBy(F.col("_key").alias(there)).agg(F.first("spans").alias(found))

    def step(state: Column, s: Column) -> Column:
        new = F.concat(F.substring(F.col(text_col), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0))), F.lit(mark))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(
            state["out"], F.when(s["start"] >= state["at"], new).otherwise(F.lit(""))).alias("out"))

    clean = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda state: F.concat(
        state["out"], F.substring(F.col(text_col), state["at"] + 1, F.char_length(F.col(text_col)))))
    marked = some.withColumn(own, key).join(spans, F.col(own) == F.col(there), "left")
    changed = marked.withColumn(text_col, F.when(F.col(found).isNull(), F.col(text_col)).otherwise(clean)).select(
        *[F.col(f"`{c}`") for c in df.columns])
    return df.where(~maybe).unionByName(changed)
