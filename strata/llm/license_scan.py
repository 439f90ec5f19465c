"""Licences of files, in built-in DataFrame functions only.

Candidate passages of a file are each line with a license word, that line with
the next one, each header block (neighbouring lines up to a blank or bare comment
line) with a license word, each run of such blocks and, for a license file, its
whole text. Templates are names, one-line statements, SPDX tags, titles, standard
headers and whole short licences (license_templates.py). Both are sparse TF-IDF
vectors over lower-case terms (weights from how many templates hold a term; terms
of no template count as rarest, so other prose lowers the match). A passage has
the license of the template of highest cosine, if that reaches MIN_COSINE; a file
has the license of its best passage. GENERAL, a name without its version, counts
only where no passage says more.

A license file speaks for its directory. A file without a license of its own
inherits that of the nearest ancestor directory that has one: every directory is
listed once with its ancestors, joined on the path to the directories' licenses,
and the answer is joined back to the files. Terms are exploded for candidate
passages only, and a common directory is one row of the small side.

Cases: null or blank texts have no passage but still inherit; a null path has no
directory and inherits nothing; equal cosines go to the first license by name;
of several license files in a directory the best match speaks; repeated rows are
reported each; very long texts are read whole, and one line may be as long as
its text; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.license_templates import templates
from strata.llm.tables import numbered, saved

MIN_COSINE = 0.6
TEMPLATES = templates()
GENERAL = "GPL-1.0-or-later"
_WORDS = "licen[cs]e|copyright|spdx|public domain|all rights reserved|redistribut|permission is hereby|permission to use"
CUE = f"(?i){_WORDS}"
LICENSE_FILE = "(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"
_TERM = "[^a-z0-9.+-]+"
_BLANK = r"\n[ \t\r#*/;%-]*\n"  # ends a block; a second blank line begins the next one
_OTHER, _NEXT = "\x01", "\x02"  # stand for a block without a license word, and between blocks of a run


def _terms(text: Column) -> Column:
    """Lower-case terms; dots and hyphens stay inside a term only."""
    parts = F.split(F.lower(text), _TERM)
    trimmed = F.transform(parts, lambda t: F.regexp_replace(t, "^[.+-]+|[.+-]+$", ""))
    return F.filter(trimmed, lambda t: t != "")


def template_weights(spark: SparkSession, templates: list[tuple[str, str]]) -> tuple[DataFrame, float]:
    """((license, template, term, idf, weight of the unit vector), idf of terms in no template)."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)])
    base = spark.range(1).select(F.inline(rows))
    counts = base.select("template", "license", F.explode(_terms(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    many = len(templates)
    idf = counts.groupBy("term").agg((F.log((1.0 + many) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    weighted = counts.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return (
        weighted.join(norm, "template").select("license", "template", "term", "idf", (F.col("w") / F.col("norm")).alias("weight")),
        _rarest(many),
    )


def _rarest(many: int) -> float:
    import math

    return math.log(1.0 + many) + 1.0


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _directory(path: Column) -> Column:
    """Path up to its last slash; files at the top are in ''."""
    return F.regexp_replace(F.regexp_extract(path, "^(.*)/[^/]*$", 1), "/+$", "")


def passages(files: DataFrame) -> DataFrame:
    """files(uid, path, text) -> (uid, kind, place, passage); kinds: 0 whole license
    file, 1 line, 2 line and the next, 3 block, 4 run of blocks."""
    speaks = _name(F.col("path")).rlike(LICENSE_FILE)
    at = files.where(F.col("text").rlike(CUE) | speaks).select(
        "uid", F.coalesce(speaks, F.lit(False)).alias("speaks"), "text", F.split("text", "\n").alias("lines"), F.split("text", _BLANK).alias("blocks")
    )
    passage = lambda kind, place, text: F.struct(F.lit(kind).alias("kind"), place.alias("place"), text.alias("passage"))
    stating = lambda p: p["passage"].rlike(CUE)
    at = at.select(
        "uid", "speaks", "text", "lines",
        F.filter(F.transform("lines", lambda line, i: passage(1, i, line)), stating).alias("ones"),
        F.filter(F.transform("blocks", lambda block, i: passage(3, i, block)), stating).alias("stated"),
        F.array_join(F.transform("blocks", lambda b: F.when(b.rlike(CUE), b).otherwise(F.lit(_OTHER))), _NEXT).alias("marked"),
    )
    following = F.filter("ones", lambda p: p["place"] + 1 < F.size("lines"))
    runs = F.transform(F.split("marked", _OTHER), lambda run, i: passage(4, i, run))
    whole = F.when(F.col("speaks"), F.array(passage(0, F.lit(-1), F.col("text")))).otherwise(F.array().cast("array<struct<kind:int,place:int,passage:string>>"))
    found = F.concat(
        "ones",
        F.transform(following, lambda p: passage(2, p["place"], F.concat_ws(" ", p["passage"], F.get("lines", p["place"] + 1)))),
        F.filter("stated", lambda p: p["passage"].contains("\n")),
        F.filter(runs, lambda p: F.regexp_replace(p["passage"], f"^{_NEXT}|{_NEXT}$", "").contains(_NEXT)),  # of two blocks and more
        whole,
    )
    return at.select("uid", F.inline(found))


def own_licenses(files: DataFrame, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """(uid, license, score, kind, place) of each file's best passage."""
    weights, rarest = template_weights(files.sparkSession, templates)
    key = ["uid", "kind", "place"]
    terms = passages(files).select(*key, F.explode(_terms(F.col("passage"))).alias("term"))
    counts = saved(terms.groupBy(*key, "term").agg(F.count("*").alias("tf")), "license-terms")
    idf = weights.groupBy("term").agg(F.first("idf").alias("idf"))
    known = F.col("idf").isNotNull()
    tf_idf = counts.join(idf, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(rarest)))
    square = F.col("w") * F.col("w")
    norms = tf_idf.groupBy(*key).agg(F.sqrt(F.sum(square)).alias("norm"), F.sqrt(F.sum(F.when(known, square).otherwise(0.0))).alias("inside"))
    # no cosine is above the share of the passage's length that lies in terms of the templates
    likely = norms.where(F.col("inside") >= F.col("norm") * (least - 1e-6)).select(*key, "norm")
    dots = counts.join(likely, key).join(weights, "term").groupBy(*key, "license", "template").agg(
        F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"), F.first("norm").alias("norm")
    )
    # rounded, so that equal passages tie whatever the order of their sums
    scores = dots.withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= least)
    general = (F.col("license") == GENERAL).alias("general")
    minus = (-F.col("score")).alias("minus")
    of_passage = scores.groupBy(*key).agg(F.min(F.struct(minus, "license")).alias("p"))
    of_passage = of_passage.select(*key, "p.license", (-F.col("p.minus")).alias("score"))
    best = F.min(F.struct(general, minus, "license", "kind", "place")).alias("best")
    return of_passage.groupBy("uid").agg(best).select("uid", "best.license", (-F.col("best.minus")).alias("score"), "best.kind", "best.place")


def inherited(directories: DataFrame, speaking: DataFrame) -> DataFrame:
    """directories(directory), speaking(directory, license) -> (directory,
    license, from_directory) of the nearest ancestor (itself first) that speaks."""
    parts = F.split("directory", "/")
    depth = F.when(F.col("directory") == "", F.lit(0)).otherwise(F.size(parts))
    up = directories.select(
        "directory", F.explode(F.sequence(F.lit(0), depth)).alias("levels"),
        parts.alias("parts"),
    ).select("directory", "levels", F.array_join(F.slice("parts", 1, F.col("levels")), "/").alias("ancestor"))
    found = up.join(speaking.select(F.col("directory").alias("ancestor"), "license"), "ancestor")
    best = F.max(F.struct("levels", "license", "ancestor")).alias("best")
    return found.groupBy("directory").agg(best).select("directory", "best.license", F.col("best.ancestor").alias("from_directory"))


def licenses(
    files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES, least: float = MIN_COSINE,
) -> DataFrame:
    """One row per file: doc_id, path, license, score (cosine of its own passage),
    origin ('own', 'inherited' or 'none') and from_directory."""
    rows = numbered(files, id_col, path_col, text_col).select(
        "uid", F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{path_col}`").cast("string").alias("path"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    own = saved(own_licenses(rows, templates, least), "licenses")
    slim = rows.select("uid", "doc_id", "path", _directory(F.col("path")).alias("directory"))
    table = saved(slim.join(own, "uid", "left"), "files")
    speaking = (
        table.where(F.col("license").isNotNull() & _name(F.col("path")).rlike(LICENSE_FILE))
        .groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
        .select("directory", "best.license")
    )
    nearest = inherited(table.select("directory").where("directory IS NOT NULL").distinct(), speaking)
    nearest = nearest.select("directory", F.col("license").alias("passed_on"), "from_directory")
    mine = F.col("license").isNotNull()
    return table.join(nearest, "directory", "left").select(
        "doc_id", "path",
        F.coalesce("license", "passed_on").alias("license"),
        F.round("score", 6).alias("score"),
        F.when(mine, "own").when(F.col("passed_on").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("from_directory")).alias("from_directory"),
    )


def as_files(docs: DataFrame) -> DataFrame:
    """documents as a source tree (the table has no paths): of the documents with
    a license statement, those of even id are the license file of a directory;
    all others are text files. Directories nest two deep under the source."""
    number = F.coalesce(F.col("doc_id"), F.lit(0).cast("long"))
    speaks = F.coalesce(F.col("text").rlike(CUE), F.lit(False)) & (F.pmod(number, F.lit(2)) == 0)
    name = F.when(speaks, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt")))
    top = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.pmod(number, F.lit(7)))
    # every other license file speaks for the upper directory
    deep = F.when(speaks & (F.pmod(number, F.lit(4)) == 0), F.lit(None)).otherwise(F.pmod(F.floor(number / 7), F.lit(50)))
    return docs.select("doc_id", F.concat_ws("/", top, deep, name).alias("path"), "text")


def _oracle() -> str:
    quoted = [(name, text.replace("'", "''")) for name, text in TEMPLATES]
    values = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(quoted))
    terms = r"list_filter(list_transform(regexp_split_to_array(lower({0}), '[^a-z0-9.+-]+'), lambda t: regexp_replace(t, '^[.+-]+|[.+-]+$', '', 'g')), lambda t: t <> '')"
    cue = _WORDS
    return rf"""
WITH templates(template, license, text) AS (VALUES {values}),
tt AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({terms.format("text")}) AS term FROM templates) GROUP BY ALL),
idf AS (SELECT term, ln((1.0::DOUBLE + {len(TEMPLATES)}) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf FROM tt GROUP BY term),
tw AS (
  SELECT template, license, term, idf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS weight FROM tt JOIN idf USING (term)
), named AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(doc_id, 0) AS number, coalesce(source, 'unknown') AS top, coalesce(text, '') AS text,
    regexp_matches(coalesce(text, ''), '{cue}', 'i') AND coalesce(doc_id, 0) % 2 = 0 AS speaks FROM documents
), dirs AS (
  SELECT *, concat_ws('/', top, number % 7, CASE WHEN speaks AND number % 4 = 0 THEN NULL ELSE (number // 7) % 50 END) AS directory,
    CASE WHEN speaks THEN 'LICENSE-' || number ELSE number || '.txt' END AS name FROM named
), files AS (
  SELECT uid, doc_id, directory || '/' || name AS path, directory, speaks, text FROM dirs
), parts AS (
  SELECT uid, string_split(text, chr(10)) AS lines, regexp_split_to_array(text, '{_BLANK}') AS blocks
  FROM files WHERE regexp_matches(text, '{cue}', 'i')
), lines AS (
  SELECT uid, place, lines[place] AS passage, lines[place + 1] AS following
  FROM (SELECT uid, lines, unnest(range(1, len(lines) + 1)) AS place FROM parts) WHERE regexp_matches(lines[place], '{cue}', 'i')
), blocks AS (
  SELECT uid, unnest(range(len(blocks))) AS place, unnest(blocks) AS passage, unnest(list_transform(blocks, lambda b: regexp_matches(b, '{cue}', 'i'))) AS states
  FROM parts
), islands AS (
  SELECT *, place - row_number() OVER (PARTITION BY uid ORDER BY place) AS island FROM blocks WHERE states
), passages AS (
  SELECT uid, 1 AS kind, place, passage FROM lines
  UNION ALL SELECT uid, 2, place, passage || ' ' || following FROM lines WHERE following IS NOT NULL
  UNION ALL SELECT uid, 3, place, passage FROM blocks WHERE states AND contains(passage, chr(10))
  UNION ALL SELECT uid, 4, min(place), string_agg(passage, ' ' ORDER BY place) FROM islands GROUP BY uid, island HAVING count(*) > 1
  UNION ALL SELECT uid, 0, -1, text FROM files WHERE speaks
), counts AS (
  SELECT uid, kind, place, term, count(*) AS tf FROM (SELECT uid, kind, place, unnest({terms.format("passage")}) AS term FROM passages) GROUP BY ALL
), norms AS (
  SELECT uid, kind, place, sqrt(sum((tf * w) * (tf * w))) AS norm
  FROM (SELECT counts.*, coalesce(idf, ln(1.0::DOUBLE + {len(TEMPLATES)}) + 1.0::DOUBLE) AS w FROM counts LEFT JOIN idf USING (term)) GROUP BY ALL
), scores AS (
  SELECT uid, kind, place, license, template, round(sum(tf * idf * weight) / any_value(norm), 9) AS score
  FROM counts JOIN tw USING (term) JOIN norms USING (uid, kind, place) GROUP BY uid, kind, place, license, template
), of_passage AS (
  SELECT uid, kind, place, license, score FROM scores WHERE score >= {MIN_COSINE}
  QUALIFY row_number() OVER (PARTITION BY uid, kind, place ORDER BY score DESC, license) = 1
), own AS (
  SELECT uid, license, score FROM of_passage
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY license = '{GENERAL}', score DESC, license, kind, place) = 1
), tab AS (
  SELECT files.*, license, score FROM files LEFT JOIN own USING (uid)
), speaking AS (
  SELECT directory, license FROM tab WHERE license IS NOT NULL AND speaks
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, license) = 1
), up AS (
  SELECT directory, level, array_to_string(list_slice(string_split(directory, '/'), 1, level), '/') AS ancestor
  FROM (SELECT directory, unnest(range(0, len(string_split(directory, '/')) + 1)) AS level FROM (SELECT DISTINCT directory FROM tab))
), nearest AS (
  SELECT up.directory, s.license AS passed_on, ancestor AS from_directory FROM up JOIN speaking s ON up.ancestor = s.directory
  QUALIFY row_number() OVER (PARTITION BY up.directory ORDER BY level DESC) = 1
)
SELECT doc_id, path, coalesce(license, passed_on) AS license, round(score, 6) AS score,
  CASE WHEN license IS NOT NULL THEN 'own' WHEN passed_on IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN license IS NULL THEN from_directory END AS from_directory
FROM tab LEFT JOIN nearest USING (directory)
"""


ORACLE_SQL = _oracle()
