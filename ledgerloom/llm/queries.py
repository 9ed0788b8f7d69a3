"""The queries of the operators, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.llm import decontamination, embeddings, manifest, mixing, quality, search, secrets, simhash, suffix_dedup, tokens, toxicity, url_filter, warc
from ledgerloom.session import scratch_path


@query(
    "op1_warc_reassembly",
    oracle="""
    WITH own AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    named AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex FROM own),
    firsts AS (SELECT hex, max(page_id) AS first_id FROM named GROUP BY hex)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT // (32768 >> (5 * (i % 4))::INT)) % 32 + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, true AS verified
    FROM named JOIN firsts USING (hex)""",
)
def op1_warc_reassembly(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    return warc.resolved(spark, path)


@query(
    "op2_mix_sources",
    oracle="""
    WITH sized AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, encode(source))) - 1) % 3 + 1] AS weight FROM per),
    filled AS (SELECT *, row_number() OVER rising AS turn,
        sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing
        FROM weighed WINDOW rising AS (ORDER BY source_size / weight, source IS NULL, encode(source))),
    marked AS (SELECT *, 3 * source_size * sharing < weight * rest AS cut FROM filled),
    level AS (SELECT arg_min(rest, turn) AS rest, arg_min(sharing, turn) AS sharing FROM marked WHERE NOT cut),
    aims AS (SELECT source, source_size, CASE WHEN cut THEN 3.0 * source_size ELSE (weight * level.rest)::DOUBLE / level.sharing::DOUBLE END::DOUBLE AS target FROM marked, level),
    units AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 4294967296)::HUGEINT ELSE 0::HUGEINT END AS units,
        ('0x' || substr(md5(coalesce('42:s' || source, '42:n')), 1, 8))::HUGEINT AS start FROM aims),
    run AS (SELECT doc_id, size, source_size, target, units,
        start + units * row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) AS upto
        FROM sized s JOIN units u ON s.source IS NOT DISTINCT FROM u.source)
    SELECT doc_id, size, source_size, target, ((upto // 4294967296) - ((upto - units) // 4294967296))::BIGINT AS copies,
           (size * ((upto // 4294967296) - ((upto - units) // 4294967296)))::BIGINT AS taken
    FROM run""",
)
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


def _sql_matches(kind: int, pattern: str, group: int = 0, least: int = 0) -> str:
    """SQL for the spans of a pattern in ``body``: running lengths of matches and of what lies between them."""
    value = f"regexp_extract_all(body, '{pattern}', {group})"
    return f"""
        SELECT rid, {kind} AS kind, start, start + length(hit) AS stop, value FROM (
            SELECT rid, n, hit, value, sum(length(gap)) OVER run + coalesce(sum(length(hit)) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM (SELECT rid, unnest(hits) AS hit, unnest(vals) AS value, unnest(gaps[1:len(hits)]) AS gap, unnest(range(len(hits))) AS n
                  FROM (SELECT rid, regexp_extract_all(body, '{pattern}', 0) AS hits, {value} AS vals, string_split_regex(body, '{pattern}') AS gaps FROM own))
            WINDOW run AS (PARTITION BY rid ORDER BY n))
        WHERE length(value) >= {least}"""


_ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"


@query(
    "op6_secret_scan",
    oracle=f"""
    WITH own AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
    base AS ({_sql_matches(0, _ASSIGN, 1, 6)} UNION ALL {_sql_matches(1, "AKIA[A-Z0-9]{16,}")} UNION ALL {_sql_matches(2, "[0-9a-f]{24,}")}),
    strings AS ({_sql_matches(3, "[A-Za-z0-9+/_=-]{20,}")}),
    free AS (SELECT * FROM strings c WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid AND b.start < c.stop AND c.start < b.stop)
        AND NOT regexp_matches(value, '^[A-Z]?[a-z=_+/-]+$|^[A-Z=_+/-]+$|^[0-9=_+/-]+$')
        AND NOT regexp_matches(value, '^[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$')
        AND NOT regexp_matches(value, '(?i)example|sample|dummy|placeholder|changeme|xxxx')
        AND NOT regexp_matches(value, '^(/?[a-z0-9_-]+)+/[a-z0-9_-]*$')),
    hot AS (SELECT rid, kind, start, stop, value FROM free
        WHERE list_max(list_transform(range(length(value) - 19), lambda i: list_entropy(string_split(substr(value, i + 1, 20), '')))) >=
            CASE WHEN regexp_matches(value, '^[A-Za-z=_+/-]+$') THEN 4.05 WHEN regexp_matches(value, '^[0-9a-fA-F]+$') THEN 3.05
                 WHEN regexp_matches(value, '^[A-Za-z0-9]+$') THEN 3.75 WHEN regexp_matches(value, '^[A-Za-z0-9_=-]+$') THEN 3.85 ELSE 3.95 END),
    spans AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start || ':' || stop AS said FROM (FROM base UNION ALL FROM hot)),
    listed AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM own LEFT JOIN listed USING (rid)""",
)
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind_no"] < 3)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


@query(
    "op7_url_filter",
    oracle=r"""
    WITH own AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', ['host', 'path', 'rest']), {'host': '', 'path': '', 'rest': ''}) AS a FROM pages),
    cut AS (SELECT page_id, translate(a.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, a.path AS path, a.rest AS rest FROM own),
    judged AS (SELECT page_id, host, path, host || path || rest AS subject,
        CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
             WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM cut)
    SELECT page_id, host, path, rule,
        CASE WHEN rule IS NOT NULL THEN CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' ELSE 'block' END
             WHEN regexp_matches(subject, '(?i)^(?:[^/?#]*\.)?wikipedia\.org(?:[^A-Za-z0-9_.%-]|$)') THEN 'allow'
             WHEN regexp_matches(subject, '(?is)^(?:[^/?#]*\.)?ads\..*(?:[^A-Za-z0-9_.%-]|$)|^(?:[^/?#]*\.)?doubleclick\..*(?:[^A-Za-z0-9_.%-]|$)|/wp-login\.php(?:[^A-Za-z0-9_.%-]|$)|/wp-admin/|/cart/|/checkout/|/login(?:[^A-Za-z0-9_.%-]|$)|/signup(?:[^A-Za-z0-9_.%-]|$)|(?:[^A-Za-z0-9_.%-]|$)replytocom=|(?:[^A-Za-z0-9_.%-]|$)sessionid=|[^A-Za-z0-9_.%-]utm_.*=.*[^A-Za-z0-9_.%-]utm_|/tag/.*/page/|\.(zip|exe|mp4)$') THEN 'block'
             ELSE 'allow' END AS verdict
    FROM judged""",
)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), url_filter.rules(spark))
    return judged.select("page_id", "host", "path", F.when(F.col("priority") == 1, F.col("rule")).alias("rule"), "verdict")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_embedding_near_dedup")
def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.classes(table(spark, folder, "embeddings"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_quality_resampling")
def op5_quality_resampling(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    found = quality.resample(table(spark, folder, "documents").select("doc_id", "text"), labels)
    return found.select("doc_id", "log_weight", "key", "kept")


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "score", "start_word", "end_word")


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.removed(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _sql_fields(n_chars: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _sql_levels(name: str, start: str) -> str:
    """SQL for the levels of trees: ``tree, level, nodes``, from the lists of ``start``."""
    return f"""{name} AS (
        SELECT tree, 0 AS level, nodes FROM ({start})
        UNION ALL
        SELECT tree, level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
        FROM {name} WHERE len(nodes) > 1)"""


def _sql_steps(levels: str, tree: str, pos: str) -> str:
    """SQL for the siblings on the way up: each with its side in front, or ``-`` for a node alone."""
    other = f"nodes[({pos} >> level) + 2 - 2 * (({pos} >> level) % 2)]"
    return f"""(SELECT list(CASE WHEN {other} IS NULL THEN '-' ELSE CASE WHEN ({pos} >> level) % 2 = 1 THEN 'L' ELSE 'R' END || {other} END ORDER BY level)
        FROM {levels} l WHERE l.tree = {tree} AND len(nodes) > 1)"""


@query(
    "op11_merkle_manifest",
    oracle=f"""
    WITH RECURSIVE own AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || lang, 'n') AS tree, doc_id::VARCHAR AS digits, {_sql_fields("n_chars")} AS leaf, {_sql_fields("(n_chars + 1)")} AS other FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM own),
    {_sql_levels("low", "SELECT tree, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY tree")},
    subroots AS (SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM low WHERE len(nodes) = 1),
    {_sql_levels("high", "SELECT '' AS tree, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0")},
    crc AS (SELECT rid, digits IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT, range(8 * length(digits))),
        lambda c, i: CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END::BIGINT) % 2 = 1
            THEN xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END::BIGINT) >> 1, 3988292384::BIGINT)
            ELSE xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(digits, i // 8 + 1, 1)) ELSE 0 END::BIGINT) >> 1 END), 4294967295::BIGINT) % 7 = 0 AS tampered FROM own),
    walked AS (SELECT p.doc_id, p.leaf, s.subroot, CASE WHEN c.tampered THEN p.other ELSE p.leaf END AS start,
        list_concat(coalesce({_sql_steps("low", "p.tree", "p.pos")}, []), coalesce({_sql_steps("high", "''", "s.place")}, [])) AS steps
        FROM placed p JOIN subroots s USING (tree) JOIN crc c USING (rid)),
    done AS (SELECT *, (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root,
        list_reduce(list_prepend(start, steps), lambda h, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || h WHEN 'R' THEN h || s[2:] ELSE h END)) AS folded_root FROM walked)
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM done""",
)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) if c != "n_chars" else F.col(c).cast("decimal(20,0)") + 1 for c in manifest.COLUMNS]
    made = manifest.build(docs, other=F.when(tampered, F.unhex(manifest.leaf(changed))))
    root = F.lit(made.root).cast("binary")
    hexed = lambda c: F.lower(F.hex(c))
    found = manifest.proofs(made).select(F.col("id").alias("doc_id"), "digest", "other", "siblings", "sides", "subroot")
    found = found.withColumn("folded_root", manifest.folded(hexed(F.coalesce("other", "digest")), F.col("siblings"), F.col("sides")))
    proof = F.sha2(hexed("siblings"), 256).alias("proof_sha256")
    return found.select("doc_id", hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"), hexed(root).alias("root"), proof, "folded_root", (F.col("folded_root") == hexed(root)).alias("verified"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_ranked_search",
    oracle=f"""
    WITH own AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format("text")} AS terms FROM documents),
    whole AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS words FROM own WHERE len(terms) > 0),
    tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM own) GROUP BY ALL),
    wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
        FROM tf, whole GROUP BY term, docs),
    lengths AS (SELECT rid, doc_id, 75 + (25 * len(terms) * docs) // words AS m FROM own, whole WHERE len(terms) > 0),
    scores AS (SELECT item_id, rid, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
        FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (rid) GROUP BY ALL)
    SELECT item_id, rank, doc_id, score FROM (
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score FROM scores WHERE score > 0)
    WHERE rank <= 20""",
)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    found = search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = tokens.with_counts(docs.select("*", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", tokens.over(F.col("n_tokens")).alias("over_limit"))
