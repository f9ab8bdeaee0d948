"""Registered queries over the operators of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    chat, decontamination, exact_dedup, filter_audit, licenses, line_dedup, near_dedup, packing, pii,
    prefix_trie, quality, sharding, substring_dedup,
)
from shelfmark.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


#: A turn whose text looks like the template's own markers; the query formats it as conversation -1.
PROBE = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    made = chat.assemble(chat.format_turns(given.unionByName(probe)))
    turns = F.array_join(F.transform(chat.parse_turns(F.col("formatted")),
                                     lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.withColumn("_loss", chat.loss_text(F.col("segments"))).select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def _chat_sql() -> str:
    template = chat.INSTRUCT
    extra = {role: len(t.before) + len(t.after) for role, t in template.turns.items()}
    cases = " ".join(f"WHEN role = '{r}' THEN {n}" for r, n in extra.items())
    other = sum(map(len, template.named))
    legal = " ".join(f"WHEN prev = '{r}' THEN role IN ({', '.join(repr(f) for f in t.follow)})"
                     for r, t in template.turns.items())
    first, last = (", ".join(repr(r) for r in roles) for roles in (template.first, template.last))
    # Escaping adds one character for each escape character and each control string.
    marks = " + ".join(f"(length(x) - length(replace(x, '{m}', ''))) // {len(m)}" for m in (chat.ESCAPE, *template.controls))
    return f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
n AS (SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS prev FROM t
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
m AS (SELECT *, (SELECT {marks} FROM (SELECT text AS x)) AS added,
    CASE WHEN role IN ({', '.join(repr(r) for r in extra)}) THEN 0 ELSE length(role) END AS named,
    CASE {cases} ELSE {other} END AS framed,
    coalesce(CASE WHEN prev IS NULL THEN role IN ({first}) {legal} ELSE false END, false) AS legal FROM n),
g AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS loss,
    CAST(sum(length(text) + added + named + framed) AS BIGINT) AS formatted_chars,
    bool_and(legal) AND arg_max(role, pos) IN ({last}) AS valid FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars, valid FROM g"""


def op5_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffle_into_shards(read(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read(spark, sf_dir, "documents"), pii.train_field(pii.labelled_table()))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))


REPEATS_SQL = """
WITH words AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
wins AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13),
named AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM wins),
hits AS (SELECT doc_id, i FROM named QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS r FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(len(r), 0) AS n_removed,
    sha256(array_to_string(CASE WHEN r IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(r, i)) END, ' ')) AS kept_sha256
FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id"""


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW w AS (PARTITION BY t)"""

def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


NEAR_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
posts AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS met
    FROM posts a JOIN posts b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common WHERE 100 * met >= 85 * (na + nb - met)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, s.b FROM reach r JOIN steps s ON r.b = s.a),
least_id AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least_id ON a = doc_id"""


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.score_quality(docs, quality.fit_quality(docs, labels))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES_SQL = f"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
lines AS (SELECT doc_id, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS i FROM texts),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, i, line, coalesce(keeper <> doc_id, false) AS gone FROM keyed LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM texts),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask
    FROM words LEFT JOIN flags USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM masks GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order FROM f a, f b, f c, f d, f e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
places AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
    FROM orders, unnest(range(1, 6)) AS s(step)),
steps AS (SELECT filter_order, step::INT AS step, letter, bit, list_sum(list_transform(string_split(earlier, ''),
    lambda x: CASE x WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 4 WHEN 'D' THEN 8 WHEN 'E' THEN 16 ELSE 0 END))::INT AS used
    FROM places JOIN f USING (letter)),
found AS (SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (WHERE mask & (used | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & used = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & used <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & bit <> 0 AND mask & used = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE mask & bit <> 0 AND mask & used = 0), 0)::BIGINT AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM found"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


TRIE_SQL = """
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST) AS t FROM given GROUP BY conv_id),
heads AS (SELECT conv_id, t, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 9 AS h FROM lists),
built AS (SELECT a.conv_id, list_concat(coalesce(b.t, [])[1:a.h], a.t[a.h + 1:]) AS t
    FROM heads a LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 5),
paths AS (SELECT conv_id, len(t) AS size, unnest(range(0, len(t) + 1)) AS depth, t FROM built),
named AS (SELECT conv_id, size, depth, sha256(t[1:depth]::JSON::VARCHAR) AS node, CASE WHEN depth > 0 THEN sha256(t[1:depth - 1]::JSON::VARCHAR) END AS parent,
    CASE WHEN depth > 0 THEN strlen(t[depth].text) ELSE 0 END AS bytes FROM paths),
nodes AS (SELECT node, depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth) AS ends FROM named GROUP BY node, depth),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
facts AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
below AS (SELECT p.node, sum((f.n_convs - 1) * f.bytes)::BIGINT AS saved_tokens, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves
    FROM facts f JOIN named p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.node)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM facts f JOIN below USING (node) LEFT JOIN facts p ON p.node = f.parent"""


REGISTRY = {
    "op1_license_scan": op1_license_scan,
    "op2_decontamination": op2_decontamination,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_chat_format": op4_chat_format,
    "op5_shard_shuffle": op5_shard_shuffle,
    "op6_personal_data": op6_personal_data,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_line_dedup": op11_line_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = {
    "op1_license_scan": licenses.scan_sql(),
    "op4_chat_format": _chat_sql(),
    "op7_substring_dedup": REPEATS_SQL,
    "op8_exact_dedup": EXACT_SQL,
    "op9_near_dedup": NEAR_SQL,
    "op11_line_dedup": LINES_SQL,
    "op12_filter_audit": AUDIT_SQL,
    "op13_prefix_trie": TRIE_SQL,
}
