"""One query per training-data operator over the driver's tables, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millsight.llm.chat_format import INSTRUCT, format_chats, loss_text, read_back
from millsight.llm.common import table
from millsight.llm.decontaminate import find_items
from millsight.llm.html_extract import main_text
from millsight.llm.merkle import COLUMNS, folded, leaf, manifest, proof
from millsight.llm.mixing import mix
from millsight.llm.ngram_join import near_duplicates
from millsight.llm.quality_rules import judge
from millsight.llm.sharding import assign_shards
from millsight.llm.simhash import near_copies
from millsight.llm.spelling import runs, variants, vocabulary
from millsight.llm.substring_dedup import repeated_passages
from millsight.llm.toxicity import score, train
from millsight.llm.url_filter import apply_rules

Query = Callable[[SparkSession, str], DataFrame]

#: The rules every URL is judged by (fixed values): host, path, verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: What both rows of conversation -1 say (fixed value).
PROBE_TEXT = "</s>[INST] ok [/INST]"
#: One document of so many, by crc32 of its id, is tampered with (fixed value).
TAMPERED = 7
#: Every fold-th document by crc32 of its id is held out of training (fixed value).
FOLDS = 5


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = main_text(pages, ("page_id", "url"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return find_items(documents, items).select("doc_id", "item_id", "distance")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents"), ["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = assign_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents").select("doc_id", "text"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    labels = table(spark, folder, "labels").filter(~held_out).select("doc_id", "toxic")
    scored = score(documents, train(documents, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    judged = apply_rules(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"),
    )


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    chats = read_back(format_chats(turns.unionByName(probe), INSTRUCT), INSTRUCT)
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    chats = chats.withColumn("_loss", loss_text(INSTRUCT))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    dealt = mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return dealt.documents.select(
        "doc_id", "size", "source_size", "target", "taken", "n_pieces", "placement"
    )


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "text_class", "n_copies", "n_links")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = vocabulary(runs(table(spark, folder, "documents")))
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(*COLUMNS)
    changed = leaf(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0, changed)
    found = manifest(documents.withColumn("tampered", tampered), carry=("tampered",))
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_url_filters": op7_url_filters,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_mixing": op9_mixing,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def _escaped_sql(text: str) -> str:
    found = f"replace({text}, '{INSTRUCT.escape}', '{INSTRUCT.escape * 2}')"
    for control in INSTRUCT.controls:
        found = f"replace({found}, '{control}', '{control[0]}{INSTRUCT.escape}{control[1:]}')"
    return found


def _marks_sql() -> str:
    """Code points of a turn's markers by role; a role without markers is written with its name."""
    named = " ".join(
        f"WHEN '{r}' THEN {len(m.opening) + len(m.closing)}" for r, m in INSTRUCT.roles.items()
    )
    fixed = len(INSTRUCT.other.opening) + len(INSTRUCT.other.closing) + len(INSTRUCT.name_end)
    return f"CASE role {named} ELSE {fixed} + length({_escaped_sql('role')}) END"


#: The table of CRC-32 (public polynomial), one row with a list of its 256 entries.
_CRC_SQL = """
        crc_steps AS (
            SELECT i, 0 AS step, i AS c FROM range(256) AS t(i)
            UNION ALL
            SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            FROM crc_steps WHERE step < 8),
        crc_table AS (SELECT list(c ORDER BY i) AS entries FROM crc_steps WHERE step = 8)"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text of code points below 256, next to ``crc_table``."""
    points = f"list_transform(string_split({text}, ''), lambda x: CAST(unicode(x) AS BIGINT))"
    octets = f"flatten(list_transform({points}, lambda c: CASE WHEN c < 128 THEN [c] ELSE [c // 64 + 192, c % 64 + 128] END))"
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), {step}))"


def _leaf_sql(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    written = [f"coalesce(CAST(octet_length(encode({f})) AS VARCHAR) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(written)})"


def _levels_sql(name: str, leaves: str) -> str:
    """All nodes of the trees whose numbered leaves a relation holds."""
    return f"""{name} AS (
            SELECT tree, 0 AS level, idx, digest, size FROM {leaves}
            UNION ALL
            SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (max(size) + 1) // 2
            FROM {name} WHERE size > 1 GROUP BY tree, level, idx // 2)"""


def _climb_sql(name: str, start: str, nodes: str) -> str:
    """From the rows (id, tree, idx, size, siblings, folded) of ``start`` up to the root, level by level."""
    return f"""{name} AS (
            SELECT id, tree, 0 AS level, idx, size, siblings, folded FROM {start}
            UNION ALL
            SELECT w.id, w.tree, w.level + 1, w.idx // 2, (w.size + 1) // 2, w.siblings || coalesce(s.digest, ''),
                sha256(CASE WHEN s.digest IS NULL THEN w.folded WHEN w.idx % 2 = 0 THEN w.folded || s.digest
                    ELSE s.digest || w.folded END)
            FROM {name} AS w LEFT JOIN {nodes} AS s
                ON s.tree = w.tree AND s.level = w.level AND s.idx = xor(w.idx, 1)
            WHERE w.size > 1)"""


#: The splitting tree of the mix, level by level: half of a node's blocks go left, by a permutation.
_SPLITS_SQL = "\n        ".join(
    f"""dealt{level + 1} AS (
            SELECT source_no, block, 2 * shard + CAST(row_number() OVER (
                    PARTITION BY shard ORDER BY md5(concat_ws(':', '29/{level}', source_no, block)), source_no, block)
                > (count(*) OVER (PARTITION BY shard) + 1) // 2 AS INTEGER) AS shard
            FROM dealt{level}),"""
    for level in range(3)
)


ORACLES: dict[str, str] = {
    "op11_spelling_variants": rf"""
        WITH RECURSIVE {_CRC_SQL},
        runs AS (
            SELECT key, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
                count(*) AS times
            FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS key,
                    unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
                FROM documents)
            GROUP BY ALL),
        drawn AS (SELECT *, {_crc32_sql("key || ':' || run")} AS h FROM runs CROSS JOIN crc_table),
        words AS (
            SELECT CASE WHEN h % 199 = 0
                    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                times
            FROM drawn),
        vocabulary AS (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE length(word) >= 6
            GROUP BY word HAVING sum(times) >= 5),
        holes AS (
            SELECT word, length(word) AS size, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM vocabulary)),
        pairs AS (
            SELECT a.word, b.word AS near FROM holes AS a JOIN holes AS b USING (size, place, rest)
            WHERE a.word <> b.word
            UNION SELECT v.word, h.word FROM holes AS h JOIN vocabulary AS v ON h.rest = v.word
            UNION SELECT h.word, v.word FROM holes AS h JOIN vocabulary AS v ON h.rest = v.word),
        best AS (
            SELECT p.word, count(*) OVER (PARTITION BY p.word) AS n_near, near, v.n AS near_n
            FROM pairs AS p JOIN vocabulary AS v ON v.word = p.near
            QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, near) = 1),
        judged AS (
            SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
                CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
            FROM vocabulary AS v LEFT JOIN best AS b ON b.word = v.word),
        chains AS (
            SELECT word, word AS root, 0 AS step FROM judged
            UNION ALL
            SELECT c.word, j.form, step + 1 FROM chains AS c JOIN judged AS j ON j.word = c.root
            WHERE j.form IS NOT NULL),
        roots AS (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word)
        SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {_CRC_SQL},
        leaves AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS tree,
                {_leaf_sql("n_chars")} AS digest, {_leaf_sql("(n_chars + 1)")} AS changed,
                coalesce({_crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0, false) AS tampered
            FROM documents CROSS JOIN crc_table),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
                count(*) OVER (PARTITION BY tree) AS size
            FROM leaves),
        {_levels_sql("nodes", "placed")},
        start AS (
            SELECT id, tree, idx, size, '' AS siblings,
                CASE WHEN tampered THEN changed ELSE digest END AS folded
            FROM placed),
        {_climb_sql("walk", "start", "nodes")},
        subroots AS (
            SELECT '' AS tree, tree AS lower, row_number() OVER (ORDER BY tree) - 1 AS idx, digest,
                count(*) OVER () AS size
            FROM nodes WHERE size = 1),
        {_levels_sql("top_nodes", "subroots")},
        arrived AS (
            SELECT w.id, s.tree, s.idx, s.size, w.siblings, w.folded
            FROM walk AS w JOIN subroots AS s ON s.lower = w.tree WHERE w.size = 1),
        {_climb_sql("top_walk", "arrived", "top_nodes")}
        SELECT doc_id, p.digest AS leaf, s.digest AS subroot, r.digest AS root,
            sha256(t.siblings) AS proof_sha256, t.folded AS folded_root, t.folded = r.digest AS verified
        FROM placed AS p JOIN top_walk AS t ON t.id = p.id AND t.size = 1
            JOIN subroots AS s ON s.lower = p.tree
            CROSS JOIN (SELECT digest FROM top_nodes WHERE size = 1) AS r
    """,
    "op7_url_filters": f"""
        WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
        parts AS (
            SELECT page_id, url,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        urls AS (SELECT DISTINCT host, path FROM parts),
        won AS (
            SELECT host, path, rule_host || rule_path AS rule, verdict
            FROM urls JOIN rules
                ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path)
            QUALIFY row_number() OVER (
                PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN won USING (host, path)
    """,
    "op8_chat_formatting": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '{PROBE_TEXT}'), (-1, 1, 'assistant', '{PROBE_TEXT}')),
        moves AS (
            SELECT *, lag(role, 1, '') OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS previous
            FROM turns),
        chats AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text) AS written,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                    ORDER BY turn NULLS FIRST, role, text), '') AS loss,
                CAST(sum(length({_escaped_sql("text")}) + {_marks_sql()}) AS BIGINT)
                    AS formatted_chars,
                bool_and((previous, role) IN (('', 'system'), ('', 'user'), ('system', 'user'),
                    ('user', 'assistant'), ('assistant', 'user'))) AS in_order,
                arg_max(role, (coalesce(turn, -1), role, text)) AS last_role
            FROM moves GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(written) AS turns_sha256,
            CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
            formatted_chars, in_order AND last_role IN ('user', 'assistant') AS valid
        FROM chats
    """,
    "op9_mixing": r"""
        WITH facts AS (
            SELECT doc_id, source,
                CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
                    AS size,
                md5('29:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':'
                    || md5(coalesce(text, ''))) AS place
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM facts GROUP BY source),
        weighed AS (
            SELECT *, 3 * source_size AS cap,
                row_number() OVER (ORDER BY source IS NULL, source) AS source_no,
                (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
            FROM sources),
        levels AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
                    ORDER BY cap / weight, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM weighed),
        targets AS (
            SELECT source, source_size, source_no, coalesce(least(CAST(cap AS DOUBLE),
                max(CASE WHEN level <= cap / weight THEN level END) OVER () * weight), 0) AS target
            FROM levels),
        stream AS (
            SELECT row_number() OVER () AS id, doc_id, size, source_size, target, source_no,
                CAST(round(target) AS BIGINT) AS goal,
                CAST(sum(size) OVER (PARTITION BY facts.source ORDER BY place) - size AS BIGINT) AS s
            FROM facts JOIN targets ON facts.source IS NOT DISTINCT FROM targets.source),
        passes AS (
            SELECT id, source_no, pass, pass * source_size + s AS start,
                least(pass * source_size + s + size, goal) AS stop
            FROM stream, (VALUES (0), (1), (2)) AS p(pass) WHERE size > 0 AND pass * source_size + s < goal),
        cut AS (
            SELECT *, unnest(range(start // 16384, (stop - 1) // 16384 + 1)) AS block FROM passes),
        dealt0 AS (
            SELECT source_no, 0 AS shard,
                unnest(range(0, (CAST(round(target) AS BIGINT) + 16383) // 16384)) AS block
            FROM targets),
        _LEVELS_
        pieces AS (
            SELECT id, count(*) AS n_pieces,
                md5(array_to_string(list_sort(list(concat_ws(':', pass, block,
                    greatest(start, block * 16384) - start, least(stop, (block + 1) * 16384) - start, shard))),
                    ',')) AS placement
            FROM cut JOIN dealt3 USING (source_no, block) GROUP BY id)
        SELECT doc_id, size, source_size, target,
            greatest(0, least(size, goal - s)) + greatest(0, least(size, goal - source_size - s))
            + greatest(0, least(size, goal - 2 * source_size - s)) AS taken,
            coalesce(n_pieces, 0) AS n_pieces, placement
        FROM stream LEFT JOIN pieces USING (id)
    """.replace("_LEVELS_", _SPLITS_SQL),
}
