"""The integrity audit: a table of rules, each a condition on rows with their look-ups joined.

Every metadata table is joined once to what its rules look up (its manifest row,
its file's digest, known ids); a rule is then a condition, a field, a severity
and a message.  All rules of a table are one array expression, exploded: one pass
over the table however many rules it has.  Files are hashed once, in ``files``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import is_blank, strip, text_of
from quarry.functions.urls import is_valid_url
from quarry.operators.dedup import last_wins

# Fields whose errors are structural, and what else makes a verdict "redo".
MAJOR = (
    "csv_parsing", "file_existence", "dataset_id", "document_id", "dataset_count", "document_count", "node_class", "node_id",
    "variable_id", "variable_name", "source_id", "target_id", "source_document", "chunk_id",
)
BROKEN_REFERENCE = "does not exist in datasets metadata"
MOST_ERRORS = 5
NODE_CLASSES = ("Dataset", "Table", "Variable", "Program")
SALTS = 16

Rule = tuple[Column, str, str, Column]
E, W = "error", "warning"


def _say(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts))


@dataclass
class Tables:
    """What is audited.  Optional tables are None where their file is missing."""

    manifest: DataFrame
    datasets: DataFrame
    documents: DataFrame
    files: DataFrame  # local_path, sha256
    document_edges: DataFrame | None = None
    variables: DataFrame | None = None
    variable_edges: DataFrame | None = None
    ontology_nodes: DataFrame | None = None
    ontology_edges: DataFrame | None = None
    unreadable: list[tuple[str, str]] = field(default_factory=list)  # optional files that cannot be read, and why


def _ids(df: DataFrame | None, column: str, like: DataFrame) -> DataFrame:
    return (df.select(F.col(column).alias("_id")) if df is not None else like.select(F.lit("").alias("_id")).limit(0)).distinct()


def known(df: DataFrame, column: str, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with a flag ``name`` whether ``column`` is among the distinct ``ids`` (_id)."""
    return df.join(ids.select(F.col("_id").alias(f"_{name}_id")), F.col(column) == F.col(f"_{name}_id"), "left").withColumn(name, F.col(f"_{name}_id").isNotNull()).drop(f"_{name}_id")


def _looked_up(df: DataFrame, t: Tables, path: str = "local_path") -> DataFrame:
    """``df`` with the manifest row of its URL and the digest of its file."""
    listed = last_wins(t.manifest.select("url", "archive_state", F.col("sha256").alias("m_sha"), "seq"), ["url"]).select(F.col("url").alias("m_url"), "archive_state", "m_sha")
    held = t.files.select(F.col("local_path").alias("f_path"), F.col("sha256").alias("f_sha")).distinct()
    out = df.withColumn("_path", strip(text_of(path)))
    return out.join(listed, F.col("source_url") == F.col("m_url"), "left").join(held, F.col("_path") == F.col("f_path"), "left")


def _occurrence(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_again``: whether an earlier row has the same key.

    The first place of a key that repeats is a summed-up minimum, joined back under
    ``SALTS`` salts, so the rows of one key are spread over as many tasks.
    """
    first = df.groupBy(key).agg(F.min("seq").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    first = first.select(F.col(key).alias("_key"), "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    mine = F.pmod(F.xxhash64("seq"), F.lit(SALTS)) == F.col("_salt")
    return df.join(first, F.col(key).eqNullSafe(F.col("_key")) & mine, "left").withColumn("_again", F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))).drop("_key", "_first", "_salt")


def _apply(df: DataFrame, file: str, item: Column, rules: list[Rule]) -> DataFrame:
    made = [F.when(c, F.struct(F.lit(f).alias("field"), F.lit(s).alias("severity"), m.alias("message"), F.lit(i).alias("rule"))) for i, (c, f, s, m) in enumerate(rules)]
    each = df.select("seq", item.alias("item_id"), F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("r"))
    return each.select(F.lit(file).alias("file"), "item_id", "r.field", "r.severity", "r.message", "seq", "r.rule")


def _padded(c: str) -> Rule:
    return strip(text_of(c)) != text_of(c), c, W, _say(f"{c} has leading/trailing whitespace: '", F.col(c), "'")


def _url_rules(severity: str, optional: bool = False) -> list[Rule]:
    url, valid = F.col("source_url"), is_valid_url(F.col("source_url"))
    given = url != "" if optional else F.lit(True)
    return [
        (given & ~valid, "source_url", severity, _say("Invalid source_url: ", url)),
        (given & valid & F.col("m_url").isNull(), "source_url", severity, _say("source_url not found in archive manifest: ", url)),
    ]


def _file_rules(what: str, severity: str, manifest_too: bool = False, optional: bool = False) -> list[Rule]:
    path, there = F.col("_path"), F.col("f_path").isNotNull()
    rules = [] if optional else [(path == "", "local_path", severity, _say(f"Empty local_path for {what}"))]
    rules.append(((path != "") & ~there, "local_path", severity, _say("Local file does not exist: ", path)))
    differs = there & (F.col("f_sha") != F.col("sha256"))
    if optional:
        differs = differs & ~is_blank(F.col("sha256"))
    rules.append((differs, "sha256", severity, _say(f"Checksum mismatch. {'Edge' if optional else 'Metadata'}: ", F.col("sha256"), ", Actual: ", F.col("f_sha"))))
    if manifest_too:
        rules.append((there & F.col("m_url").isNotNull() & (F.col("m_sha") != F.col("f_sha")), "sha256", severity, _say("Checksum mismatch with manifest. Manifest: ", F.col("m_sha"), ", Actual: ", F.col("f_sha"))))
    return rules


def _source_document_rules(what: str) -> list[Rule]:
    path = F.col("_path")
    return [
        (path == "", "source_document", E, _say(f"Empty source_document for {what}")),
        ((path != "") & F.col("f_path").isNull(), "source_document", E, _say("Source document does not exist: ", path)),
    ]


def _entities(df: DataFrame, key: str, file: str, word: str, rules: list[Rule]) -> DataFrame:
    """Findings of a table with an id: a blank id is all that a row is told; else all rules."""
    blank = is_blank(F.col(key))
    none = _apply(df.filter(blank), file, F.lit("N/A"), [(F.lit(True), key, E, _say(f"{word} row has empty {key}"))])
    label = f"{word.lower()} {key}" if word == "Ontology node" else key
    again: Rule = (F.col("_again"), key, E, _say(f"Duplicate {label.replace('Ontology', 'ontology')} encountered: ", F.col(key)))
    return none.unionByName(_apply(_occurrence(df.filter(~blank), key), file, F.col(key), [again, *rules]))


def _line(df: DataFrame) -> DataFrame:
    """Edges with their line in the file, from the order of ``seq``."""
    if dict(df.dtypes).get("line") is not None:
        return df
    parts = df.withColumn("_part", F.shiftright("seq", 33))
    before = parts.groupBy("_part").count()
    start = before.withColumn("_start", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(F.col("_part").alias("_p"), "_start")
    # seq counts rows within a partition from 0 (the lower 33 bits), so lines need no global sort.
    low = F.col("seq").bitwiseAND((1 << 33) - 1)
    return parts.join(F.broadcast(start), F.col("_part") == F.col("_p")).withColumn("line", F.col("_start") + low + 2).drop("_part", "_p", "_start")


def findings(t: Tables) -> DataFrame:
    """file, item_id, field, severity, message of everything that is wrong."""
    dataset_ids, document_ids = _ids(t.datasets, "dataset_id", t.datasets), _ids(t.documents, "document_id", t.datasets)
    variable_ids, node_ids = _ids(t.variables, "variable_id", t.datasets), _ids(t.ontology_nodes, "node_id", t.datasets)
    url = F.col("source_url")

    def archived(what: str, key: str) -> Rule:
        state = F.col("archive_state")
        return is_valid_url(url) & F.col("m_url").isNotNull() & (state != "archived"), "source_url", E, _say("source_url archive state is '", state, f"' (expected 'archived') for {what}: ", F.col(key))

    unknown: Rule = (~F.col("has_dataset"), "dataset_id", E, _say("dataset_id '", F.col("dataset_id"), f"' {BROKEN_REFERENCE}"))
    out = _entities(_looked_up(t.datasets, t), "dataset_id", "datasets.csv", "Dataset",
        [_padded("dataset_id"), _padded("source_url"), *_url_rules(E), archived("dataset", "dataset_id"), *_file_rules("dataset", E, True)])
    out = out.unionByName(_entities(known(_looked_up(t.documents, t), "dataset_id", dataset_ids, "has_dataset"), "document_id", "documents.csv", "Document",
        [_padded("document_id"), _padded("dataset_id"), _padded("source_url"), unknown, *_url_rules(E), archived("document", "document_id"), *_file_rules("document", E, True)]))
    if t.variables is not None:
        blank = lambda c, s: (is_blank(F.col(c)), c, s, _say(f"Variable row has empty {c}"))
        out = out.unionByName(_entities(known(_looked_up(t.variables, t, "source_document"), "dataset_id", dataset_ids, "has_dataset"), "variable_id", "variables.csv", "Variable",
            [_padded("variable_id"), unknown, blank("variable_name", E), blank("definition", W), blank("chunk_id", E), *_url_rules(E), *_source_document_rules("variable")]))
    ends = dataset_ids.unionByName(document_ids).distinct()

    def edges(df: DataFrame, file: str, path: str, sources: DataFrame, targets: DataFrame, source: str, target: str, weak: str, rules: list[Rule]) -> DataFrame:
        rows = known(known(_looked_up(_line(df), t, path), "source_id", sources, "has_source"), "target_id", targets, "has_target")
        own = [(~F.col("has_source"), "source_id", E, _say("source_id '", F.col("source_id"), f"' does not map to any {source}")), (~F.col("has_target"), "target_id", weak, _say("target_id '", F.col("target_id"), f"' does not map to any {target}"))]
        return _apply(rows, file, _say("Line ", F.col("line").cast("string")), own + rules)

    if t.document_edges is not None:
        out = out.unionByName(edges(t.document_edges, "document_edges.csv", "local_path", ends, ends, "dataset or document", "dataset or document", E, [*_url_rules(W, True), *_file_rules("edge", W, optional=True)]))
    if t.variable_edges is not None:
        relation: Rule = (F.col("relationship") != "contains", "relationship", W, _say("Unexpected variable relationship: ", F.col("relationship")))
        chunk: Rule = (is_blank(F.col("chunk_id")), "chunk_id", E, _say("Variable edge has empty chunk_id"))
        out = out.unionByName(edges(t.variable_edges, "variable_edges.csv", "source_document", dataset_ids, variable_ids, "dataset", "variable", E, [relation, *_url_rules(E), *_source_document_rules("variable edge"), chunk]))
    if t.ontology_nodes is not None:
        kind: Rule = (~F.col("node_class").isin(*NODE_CLASSES), "node_class", E, _say("Invalid node_class '", F.col("node_class"), "' for node ", F.col("node_id")))
        out = out.unionByName(_entities(_looked_up(t.ontology_nodes, t), "node_id", "ontology_nodes.csv", "Ontology node", [kind, *_url_rules(E), *_file_rules("ontology node", E)]))
    if t.ontology_edges is not None:
        every, words = ends.unionByName(node_ids).distinct(), "dataset, document, or ontology node"
        out = out.unionByName(edges(t.ontology_edges, "ontology_edges.csv", "local_path", every, every, words, words, W, [*_url_rules(E, True), *_file_rules("edge", E, optional=True)]))
    return out.unionByName(_whole_tables(t)).orderBy("file", "seq", "rule").select("file", "item_id", "field", "severity", "message")


def _whole_tables(t: Tables) -> DataFrame:
    """Findings on tables as a whole: empty, missing, unreadable."""
    count = lambda df, file, word: df.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(file).alias("file"), F.lit("N/A").alias("item_id"), F.lit(f"{word}_count").alias("field"), F.lit(E).alias("severity"), F.lit(f"{word.title()}s metadata file has zero rows of data").alias("message"))
    out = count(t.datasets, "datasets.csv", "dataset").unionByName(count(t.documents, "documents.csv", "document"))
    fixed = [(file, "header/parse", "csv_parsing", E, f"Failed to read: {why}") for file, why in t.unreadable]
    if t.document_edges is None and not any("document_edges" in f for f, _ in t.unreadable):
        fixed.append(("document_edges.csv", "N/A", "file_existence", W, "Document edges CSV file is missing"))
    if fixed:
        out = out.unionByName(t.datasets.sparkSession.createDataFrame(fixed, "file string, item_id string, field string, severity string, message string"))
    return out.withColumn("seq", F.lit(-1).cast("long")).withColumn("rule", F.lit(0))


def missing_tables(names: list[str]) -> list[tuple[str, str, str, str, str]]:
    """Findings for required files that are missing; the verdict is "redo"."""
    return [(n, "N/A", "file_existence", E, f"Required {n} file is missing") for n in names]


def verdict(found: DataFrame) -> DataFrame:
    """One row: verdict, errors, warnings, findings."""
    bad = F.col("severity") == E
    major = F.coalesce(F.bool_or(bad & (F.col("field").isin(*MAJOR) | F.col("message").contains(BROKEN_REFERENCE))), F.lit(False))
    counted = found.agg(F.count_if(bad).alias("errors"), F.count_if(F.col("severity") == W).alias("warnings"), F.count("*").alias("findings"), major.alias("major"))
    decided = F.when(F.col("errors") == 0, "pass").when(F.col("major") | (F.col("errors") > MOST_ERRORS), "redo").otherwise("fix")
    return counted.select(decided.alias("verdict"), "errors", "warnings", "findings")
