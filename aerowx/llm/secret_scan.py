"""Secrets in texts, judged by who owns them across the corpus.

Three kinds are found by pattern alone: assignments of a value to a
credential name, access key ids, and long hexadecimal strings.  A fourth,
``generic``, is any long run of token characters outside them that holds both
letters and digits; most such runs are not secrets, so the corpus decides.

All candidates are hashed, and for every hash the distinct repositories,
distinct owners and distinct texts are counted.  A value that many owners hold
is a copied example, and so is one that stands in many repositories of one
owner in as many different texts; exact copies of one text count once there,
as a copied document does not make its key an example.  A value that a single
owner holds otherwise and that looks random is live-looking and belongs to that
owner.  Live-looking generic runs are added to the spans; spans of the first
three kinds always stay and only get a label.

Everything is DataFrame functions.  Offsets count code points: a pattern's
matches and the pieces between them (``split`` by the same pattern) alternate,
so running sums of their lengths are the places.

Counting goes from distinct (value, owner, repository) over (value, owner) to
value, and from distinct (value, text) to value, each with map-side partial
sums, so a value in a third of all documents is spread over its owners,
repositories and texts before it meets.

Defined cases: null text counts as empty; a text of any length is scanned in
time that grows with its length and matches; a null owner is an owner; equal
texts are labelled once and every row gets the result; empty input gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, prefix_sums, prefixes, text_or_empty

#: The patterns of the base kinds, in the order in which they
#: are listed.  ``assign`` counts its second group, the others the match.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the whole run, 18 characters or more
HEX = r"[0-9a-f]{16,}"  # the whole run, 16 characters or more
ASSIGN_LENGTH = 12
#: A whole run of token characters; it counts with a letter and a digit in it.
GENERIC = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+"
#: A run with fewer different characters does not look random.
DISTINCT_CHARACTERS = 10
#: A value with at least so many owners is a copied example.
EXAMPLE_OWNERS = 3
#: So is a value in at least so many repositories and different texts, whoever
#: owns them.
EXAMPLE_REPOSITORIES = 10

KINDS = ("assign", "access", "hex", "generic")
BASE = KINDS[:3]
SPAN = "struct<start:int,place:int,kind:string,stop:int,value:string>"


def matches(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """All matches as an array of spans; ``value`` is the given group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    items = F.arrays_zip(F.transform(pieces, F.length).alias("gap"), F.transform(found, F.length).alias("size"),
                         values.alias("value"))
    before = prefix_sums(F.transform(items, lambda x: x["gap"] + x["size"]))

    def span(item: Column, at: Column) -> Column:
        start = at + item["gap"]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"),
                        (start + item["size"]).alias("stop"), item["value"].alias("value")).cast(SPAN)

    spans = F.zip_with(items, before, span)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> dict[str, Column]:
    assign = F.filter(matches(text, ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= ASSIGN_LENGTH)
    return {"assign": assign, "access": matches(text, ACCESS, "access"), "hex": matches(text, HEX, "hex")}


def looks_random(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARACTERS


def apart(runs: Column, spans: Column) -> Column:
    """The runs that no span overlaps.  Both are lists of disjoint spans; they
    are merged by their starts, and a run is free if no span before it reaches
    into it and the next one starts behind it."""
    tagged = lambda spans, tag: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(tag).alias("run"), s["stop"].alias("stop"), s.alias("span")))
    merged = F.array_sort(F.concat(tagged(spans, 0), tagged(runs, 1)))
    reach = prefixes(F.transform(merged, lambda m: F.when(m["run"] == 0, m["stop"]).otherwise(0)),
                     lambda a, b: F.greatest(a, b))
    following = F.slice(merged, F.lit(2), F.size(merged))
    lined = F.zip_with(F.zip_with(merged, reach, lambda m, r: F.struct(m.alias("m"), r.alias("reach"))), following,
                       lambda x, n: F.struct(x["m"].alias("m"), (
                           (x["m"]["run"] == 1) & (x["reach"] <= x["m"]["start"])
                           & F.coalesce((n["run"] == 1) | (n["start"] >= x["m"]["stop"]), F.lit(True))).alias("free")))
    return F.transform(F.filter(lined, lambda x: x["free"]), lambda x: x["m"]["span"])


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, with commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def counted(spans: Column, count: str) -> Column:
    """kind:start:end:count by start, then kind as listed, with commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], *[s[c].cast("string") for c in ("start", "stop", count)])), ",")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """id, owner, repository, text_key, one array of spans per kind; values
    are replaced by their hashes."""
    rows = docs.select(F.col("doc_id").alias("id"), F.col(owner).cast("string").alias("owner"),
                       F.col(repository).cast("string").alias("repository"), text_or_empty().alias("text"))
    rows = rows.select("id", "owner", "repository", F.sha2(F.col("text").cast("binary"), 256).alias("text_key"),
                       "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    rows = rows.withColumn("generic", F.filter(matches(F.col("text"), GENERIC, "generic"), lambda s: (
        s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]") & looks_random(s["value"])
        # hex and access matches lie inside one run
        & ~s["value"].rlike(HEX) & ~s["value"].rlike(ACCESS))))
    rows = rows.withColumn("generic", F.when((F.size("generic") > 0) & (F.size("assign") > 0), apart(
        F.col("generic"), F.col("assign"))).otherwise(F.col("generic")))
    hashed = {k: F.transform(c, lambda s: s.withField("value", F.sha2(s["value"].cast("binary"), 256)).withField(
        "random", looks_random(s["value"]))) for k, c in {k: F.col(k) for k in KINDS}.items()}
    return rows.select("id", "owner", "repository", "text_key", *[c.alias(k) for k, c in hashed.items()])


def ownership(candidates: DataFrame) -> DataFrame:
    """candidates (value, owner, repository, text_key) -> value,
    n_repositories, n_owners, n_texts."""
    held = candidates.select("value", "owner", "repository").distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("n"))
    owners = by_owner.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))
    texts = candidates.select("value", "text_key").distinct().groupBy("value").agg(F.count("*").alias("n_texts"))
    return owners.join(texts, "value")


def label(n_owners: Column, n_repositories: Column, n_texts: Column, random: Column) -> Column:
    spread = F.least(n_repositories, n_texts) >= EXAMPLE_REPOSITORIES
    return (F.when((n_owners >= EXAMPLE_OWNERS) | spread, "example")
            .when((n_owners == 1) & random, "live").otherwise("unclear"))


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_live, n_example by label, and n_owners, n_repositories: for every
    candidate of the text, by start, kind:start:end:count, with commas.
    ``docs`` needs doc_id, text and the two ownership columns."""
    scanned = materialize(scan(docs, owner, repository), "secrets")
    holders = scanned.select("text_key", "owner", "repository", F.explode(F.concat(*KINDS)).alias("s"))
    # both tables that are joined by a hot key are written before, so the joins
    # deal their rows anew and such a key can be split
    counts = materialize(ownership(holders.select(F.col("s.value").alias("value"), "owner", "repository",
                                                 "text_key")),
                         "secret-owners")
    spans = holders.select("text_key", "s.*").distinct()
    labelled = spans.join(counts, "value").withColumn("label", label(
        F.col("n_owners"), F.col("n_repositories"), F.col("n_texts"), F.col("random")))
    added = F.when((F.col("kind") == "generic") & (F.col("label") == "live"),
                   F.struct("start", "place", "kind", "stop"))
    by_text = labelled.groupBy("text_key").agg(
        F.collect_list(added).alias("added"),  # the spans of one text
        F.collect_list(F.struct("start", "place", "kind", "stop", "n_owners", "n_repositories")).alias("counted"),
        F.sum((F.col("label") == "live").cast("long")).alias("n_live"),
        F.sum((F.col("label") == "example").cast("long")).alias("n_example"))
    by_text = by_text.select("text_key", "added", "n_live", "n_example",
                             *[counted(F.col("counted"), c).alias(c) for c in ("n_owners", "n_repositories")])
    by_text = materialize(by_text, "secret-labels")
    plain = {k: F.transform(F.col(k), lambda s: F.struct(s["start"], s["place"], s["kind"], s["stop"])) for k in BASE}
    base = F.concat(*plain.values())
    return scanned.join(by_text, "text_key", "left").select(
        F.col("id").alias("doc_id"),
        *[F.size(F.col(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.when(F.col("added").isNull(), base).otherwise(F.concat(base, "added"))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("n_owners", "n_repositories")])
