"""Line deduplication by a log-template tree, in DataFrame functions only.

Each line follows a fixed-depth path: its number of tokens, then its ``LEADING``
first tokens. A token is variable from its first digit on, wherever it stands, so
that numbers, addresses and numbered names are the same in all lines. Below that
path a template keeps all tokens but those of one further field: the rest of the
line is cut into ``FIELDS`` segments, and there is a template for each segment left
out. Lines of fewer than ``FIELDED`` tokens have one template, without such a field.

A template recurs if lines of different documents have it. Brief lines (fewer than
``BRIEF`` tokens and ``BRIEF_CHARS`` characters, digits cut) meet by chance and recur from
``BRIEF_DOCS`` documents on; characters count beside tokens since some scripts write
no blanks. Recurring lines are dropped from all documents but the one with the
smallest id, so that a passage stays once and exact copies of a document do not all
become empty. Lines without a token have no template.

Only hashes of templates are shuffled and counted, with map-side aggregation;
the join back to the lines is one that Spark can split at a hot template. Texts
move once, to meet the numbers of their dropped lines.

Null texts stay null, empty texts empty; a text that loses all lines becomes
empty and its row stays. Rows without an id are left as they are. Rows that share
an id are one document. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake.session import stored

LEADING = 2
FIELDS = 4
FIELDED = 12
BRIEF, BRIEF_CHARS, BRIEF_DOCS = 5, 20, 20

#: A token from its first digit on, and what stands for it.
VARIABLE, MASK = "[0-9][^ \\t\\r\\n]*+", "0"


def masked(text: Column) -> Column:
    """The text with blanks for tabs and returns, and without the variable parts of tokens."""
    for blank in "\t\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.regexp_replace(text, VARIABLE, MASK)


def _templates(tokens: Column, n: Column) -> Column:
    """The hashes of a line's templates."""

    def without(j: int) -> Column:
        rest = n - LEADING
        start = LEADING + F.floor(rest * j / FIELDS).cast("int")
        end = LEADING + F.floor(rest * (j + 1) / FIELDS).cast("int")
        return F.xxhash64(n, F.lit(j), F.slice(tokens, 1, start), F.slice(tokens, end + 1, n))

    return F.when(n < FIELDED, F.array(F.xxhash64(n, F.lit(-1), tokens))).otherwise(
        F.array(*map(without, range(FIELDS)))
    )


def templates(docs: DataFrame) -> DataFrame:
    """(doc_id, version, line, brief, templates) for each line of docs (doc_id, text) that has any.

    version is a hash of the text; rows that share an id may differ in it.
    """
    lines = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split(masked(F.col("text")), "\n")).alias("line", "said")
    )
    tokens = lines.filter(F.trim("said") != "").withColumn("tokens", F.array_remove(F.split("said", " "), ""))
    sized = tokens.withColumn("n", F.size("tokens"))
    return sized.select(
        "doc_id",
        "version",
        "line",
        ((F.col("n") < BRIEF) & (F.length("said") < BRIEF_CHARS)).alias("brief"),
        _templates(F.col("tokens"), F.col("n")).alias("templates"),
    )


def recurring(lines: DataFrame) -> DataFrame:
    """(shared, first_doc, of_brief) of every template that lines of enough documents have."""
    said = lines.select("doc_id", "brief", F.explode("templates").alias("template"))
    long = (
        said.filter("NOT brief")
        .groupBy("template")
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .filter("first_doc != last_doc")
    )
    brief = (
        said.filter("brief")
        .select("template", "doc_id")
        .distinct()
        .groupBy("template")
        .agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("docs"))
        .filter(F.col("docs") >= BRIEF_DOCS)
    )
    found = [
        kind.select(F.col("template").alias("shared"), "first_doc", F.lit(flag).alias("of_brief"))
        for kind, flag in ((long, False), (brief, True))
    ]
    return found[0].union(found[1])


def _without(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped ones (sorted numbers), put together."""
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    kept = F.transform(
        F.sequence(F.lit(0), F.size(dropped)),
        lambda i: F.slice(lines, bounds[i] + 2, bounds[i + 1] - bounds[i] - 1),
    )
    return F.array_join(F.flatten(kept), "\n")


def _line_count(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def _named(docs: DataFrame, column: str) -> Column:
    """A column by its whole name, dots and all."""
    return docs["`" + column.replace("`", "``") + "`"]


def drop_recurring(docs: DataFrame, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """docs with text reduced, and two counts added; they replace columns of those names."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = stored(templates(slim))
    shared = stored(recurring(hashed))
    dropped = (
        hashed.select("doc_id", "version", "line", "brief", F.explode("templates").alias("template"))
        .join(shared, (F.col("template") == F.col("shared")) & (F.col("brief") == F.col("of_brief")))
        .filter("doc_id > first_doc")
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("version").alias("of_version"))
        .agg(F.sort_array(F.collect_set("line")).alias("dropped_lines"))
    )
    same = (docs["doc_id"].cast("long") == dropped["of_doc"]) & (
        F.xxhash64(docs["text"].cast("string")) == dropped["of_version"]
    )
    numbers = dropped["dropped_lines"]
    text = docs["text"].cast("string")
    lines = F.split(text, "\n")
    columns = [_named(docs, c) for c in docs.columns if c not in ("text", n_lines, n_dropped)]
    found = docs.join(dropped, same, "left")
    return found.select(
        *columns,
        F.when(numbers.isNull(), text).otherwise(_without(lines, numbers)).alias("text"),
        F.when(text.isNull(), 0).otherwise(_line_count(text)).cast("long").alias(n_lines),
        F.coalesce(F.size(numbers), F.lit(0)).cast("long").alias(n_dropped),
    )


ORACLE_SQL = f"""
WITH said AS (
  SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS line,
         unnest(string_split(text, chr(10))) AS said
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
masked AS (
  SELECT doc_id, text, line,
         regexp_replace(regexp_replace(said, '[\\t\\r]', ' ', 'g'), '[0-9][^ ]*', '{MASK}', 'g') AS said
  FROM said),
split AS (
  SELECT *, list_filter(string_split(said, ' '), lambda x: x <> '') AS t FROM masked),
tokens AS (
  SELECT *, len(t) AS n, len(t) < {BRIEF} AND length(said) < {BRIEF_CHARS} AS brief FROM split WHERE len(t) > 0),
fielded AS (
  SELECT *, unnest(CASE WHEN n < {FIELDED} THEN [-1] ELSE range({FIELDS}) END) AS j FROM tokens),
templates AS (
  SELECT doc_id, text, line, brief, n, j,
    CASE WHEN j < 0 THEN t ELSE t[1:{LEADING} + ((n - {LEADING}) * j) // {FIELDS}] END AS head,
    CASE WHEN j < 0 THEN [] ELSE t[{LEADING} + ((n - {LEADING}) * (j + 1)) // {FIELDS} + 1:] END AS rest
  FROM fielded),
recurring AS (
  SELECT brief, n, j, head, rest, min(doc_id) AS first_doc FROM templates
  GROUP BY brief, n, j, head, rest
  HAVING count(DISTINCT doc_id) >= CASE WHEN brief THEN {BRIEF_DOCS} ELSE 2 END),
dropped AS (
  SELECT doc_id, text, list(DISTINCT line) AS numbers
  FROM templates JOIN recurring USING (brief, n, j, head, rest)
  WHERE doc_id > first_doc GROUP BY doc_id, text)
SELECT d.doc_id,
  CASE WHEN x.numbers IS NULL THEN d.text ELSE coalesce(array_to_string(list_filter(
    string_split(d.text, chr(10)), lambda s, i: NOT list_contains(x.numbers, i - 1)), chr(10)), '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
  coalesce(len(x.numbers), 0) AS n_dropped
FROM documents d LEFT JOIN dropped x ON d.doc_id = x.doc_id AND d.text = x.text
"""
