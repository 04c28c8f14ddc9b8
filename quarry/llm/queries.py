"""The contract queries of the operators and, where SQL can say the same, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers

from quarry.llm import ann, chat, dawg, decontam, extract, langid, lines, neardup, packing, quality, tokencount, urlfilter, variants

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: The vocabulary file; a parameter of the operator.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS1 = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op1_decontamination",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS1} AS w FROM documents),
    b AS (SELECT item_id, {_WORDS1} AS w FROM benchmark WHERE item_id IS NOT NULL),
    s AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
    q AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
          FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM s)),
    g AS (SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
          FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM q) WHERE len(w) >= k)),
    h AS (SELECT g.r, g.i, g.k, q.item_id FROM g JOIN q USING (k, g)),
    c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
    t AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM h) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
           sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)""",
)
def op1(spark, sf_dir):
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query("op2_nearest")
def op2(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


@query("op3_packing")
def op3(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


@query(
    "op4_line_dedup",
    f"""
    WITH l AS (SELECT r, doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos
               FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
    k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UP}', '{_LOW}') AS key FROM l),
    g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    m AS (SELECT k.*, coalesce(doc_id <> top, false) AS gone FROM k LEFT JOIN g USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY r""",
)
def op4(spark, sf_dir):
    return lines.line_dedup(_table(spark, sf_dir, "documents"))


_TEMPLATE = "</s>[INST] ok [/INST]"
_ESC = "replace(replace(replace({}, '\\', '\\\\'), '<', '<\\'), '[', '[\\')"


@query(
    "op5_chat_format",
    f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-1, 0, 'user', '{_TEMPLATE}'), (-1, 1, 'assistant', '{_TEMPLATE}')),
    f AS (SELECT *, role = 'assistant' AS loss, length(replace({_ESC.format("role")}, '|', '|\\')) + length({_ESC.format("text")}) + 5 + 8 AS n FROM c)
    SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (loss), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (loss), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
    FROM f GROUP BY conv_id""",
)
def op5(spark, sf_dir):
    ours = spark.createDataFrame([(-1, 0, "user", _TEMPLATE), (-1, 1, "assistant", _TEMPLATE)], "conv_id long, turn long, role string, text string")
    every = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(ours)
    return chat.read_back(chat.format_records(chat.turn_records(every)))


@query("op6_language_id")
def op6(spark, sf_dir):
    return langid.identify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


@query("op7_html_extraction")
def op7(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return extract.extract(pages, extract.fit(pages))


@query(
    "op8_near_dedup",
    rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct([array_to_string(list_slice(w, i, i + 2), ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
          FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85 GROUP BY 1, 2),
    x AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
    y AS (SELECT a, b FROM x UNION ALL SELECT b, a FROM x),
    t AS (SELECT doc_id AS v, doc_id AS u FROM s UNION SELECT t.v, y.b FROM t JOIN y ON y.a = t.u),
    m AS (SELECT v, min(u) AS c FROM t GROUP BY v)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept FROM s JOIN m ON doc_id = v""",
)
def op8(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85).drop("class_id")


#: The contract's rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query(
    "op9_url_filter",
    f"""
    WITH r(h, p, v) AS (VALUES {", ".join(map(str, RULES))}),
    u AS (SELECT row_number() OVER () AS n, page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UP}', '{_LOW}'), '') AS host,
                 coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
    SELECT any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path,
           max_by(h || p, length(h || p)) AS rule, coalesce(max_by(v, length(h || p)), 'allow') AS verdict
    FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n""",
)
def op9(spark, sf_dir):
    return urlfilter.judge(_table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, action string"))


@query("op10_quality")
def op10(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _crc32(messages: str) -> str:
    """CTEs that end in crc(m, h): the crc32 of each string m of a relation, as the bytes' table entries by their distance from the end."""
    return f"""
    bits(b, v, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL
                      SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
    tab AS (SELECT b, v FROM bits WHERE k = 8),
    msg AS (SELECT DISTINCT m, hex(m) AS x FROM {messages}),
    far(d, b, v) AS (SELECT 0, b, v FROM tab UNION ALL
                     SELECT d + 1, far.b, xor(far.v >> 8, tab.v) FROM far JOIN tab ON tab.b = far.v & 255 WHERE d + 1 < (SELECT max(length(x)) // 2 FROM msg)),
    lead(n, v) AS (SELECT 0, 4294967295 UNION ALL
                   SELECT n + 1, xor(lead.v >> 8, tab.v) FROM lead JOIN tab ON tab.b = lead.v & 255 WHERE n < (SELECT max(length(x)) // 2 FROM msg)),
    parts AS (SELECT m, length(x) // 2 AS n, unnest(range(0, length(x) // 2)) AS p, x FROM msg),
    digits AS (SELECT m, n, n - 1 - p AS d, (strpos('0123456789ABCDEF', x[2 * p + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * p + 2]) - 1 AS b FROM parts),
    crc AS (SELECT m, xor(xor(any_value(lead.v), bit_xor(far.v)), 4294967295) AS h
            FROM digits JOIN far USING (d, b) JOIN lead USING (n) GROUP BY m)"""


_AFTER = {1: 3, 2: 3, 3: 4, 4: 3}  # grammar states 1 start, 2 after system, 3 after user, 4 after assistant -> after the turn that may follow


def _ways(state: int) -> str:
    """The cheapest of deleting, rewriting and keeping a row, as {cost, audit}."""
    to, initial = _AFTER[state], "a" if state == 3 else "u"
    system = "WHEN init = 's' AND fault NOT IN (1, 2) THEN {'c': f[2].c + extra, 'a': 'K' || f[2].a}" if state == 1 else ""
    return f"""list_sort([{{'c': f[{state}].c + 3, 'a': 'D' || f[{state}].a}},
        CASE WHEN fault IN (1, 2) THEN none ELSE {{'c': f[{to}].c + 2 + extra, 'a': 'R' || f[{to}].a}} END,
        CASE WHEN init = '{initial}' AND fault NOT IN (1, 2) THEN {{'c': f[{to}].c + extra, 'a': 'K' || f[{to}].a}} {system} ELSE none END])[1]"""


def _or_insert(own: str, after: str) -> str:
    return f"list_sort([{own}, {{'c': {after}.c + 2, 'a': 'I' || {after}.a}}])[1]"


@query(
    "op11_conversation_repair",
    f"""
    WITH RECURSIVE k AS (SELECT row_number() OVER () AS k, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
    base AS (SELECT k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(k.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS m
             FROM conversations c JOIN k ON k.conv_id IS NOT DISTINCT FROM c.conv_id),
    {_crc32("base")},
    hurt AS (SELECT k, turn, CASE WHEN h % 20 = 4 THEN 'user' ELSE role END AS role,
                    CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                    unnest(CASE WHEN h % 20 = 3 THEN [0, 1] ELSE [0] END) AS copy FROM base JOIN crc USING (m) WHERE h % 20 <> 0),
    told AS (SELECT *, left(role, 1) AS init, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
                    row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM hurt),
    placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, again) AS i FROM told),
    r AS (SELECT *, CASE WHEN said = '' THEN 1 WHEN again THEN 2 WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                 lag(init) OVER (PARTITION BY k ORDER BY i) || init AS pair FROM placed),
    s AS (SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                 count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                 count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY k),
    dp(k, i, f) AS (
        SELECT k, n + 1, [{{'c': 0, 'a': ''}}, {{'c': 4, 'a': 'II'}}, {{'c': 2, 'a': 'I'}}, {{'c': 0, 'a': ''}}] FROM s
        UNION ALL
        SELECT k, i, [{_or_insert("g1", "u")}, {_or_insert("g2", "u")}, u, {_or_insert("g4", "g3")}]
        FROM (SELECT *, {_or_insert("g3", "g4")} AS u
              FROM (SELECT k, i, {_ways(1)} AS g1, {_ways(2)} AS g2, {_ways(3)} AS g3, {_ways(4)} AS g4
                    FROM (SELECT r.k, r.i, f, init, fault, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS extra, {{'c': 1000000000, 'a': ''}} AS none
                          FROM dp JOIN r ON r.k = dp.k AND r.i = dp.i - 1)))),
    best AS (SELECT k, f[1].c AS cost, f[1].a AS audit FROM dp WHERE i = 1),
    e AS (SELECT k, unnest(range(1, length(audit) + 1)) AS p, audit FROM best),
    t AS (SELECT k, p, audit[p] AS edit, p - length(replace(audit[1:p], 'I', '')) AS inserted, length(replace(audit[1:p - 1], 'D', '')) AS j,
                 length(replace(audit, 'D', '')) % 2 AS system FROM e),
    o AS (SELECT t.k, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - system) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':'
                                 || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS said
          FROM t LEFT JOIN r ON r.k = t.k AND r.i = p - inserted WHERE edit <> 'D' GROUP BY t.k)
    SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
    FROM k LEFT JOIN s USING (k) LEFT JOIN best USING (k) LEFT JOIN o USING (k)""",
)
def op11(spark, sf_dir):
    return dawg.repair(_table(spark, sf_dir, "conversations"))


@query("op12_token_counts")
def op12(spark, sf_dir):
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), TOKENIZER)


@query(
    "op13_spelling_variants",
    f"""
    WITH RECURSIVE base AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS m, run, n FROM (
        SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY 1, 2)),
    {_crc32("base")},
    w AS (SELECT word, sum(n)::BIGINT AS n FROM (
              SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM base JOIN crc USING (m))
          WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    gap AS (SELECT word, left(word, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
    pair AS (SELECT a.word AS a, b.word AS b FROM gap a JOIN gap b ON a.l = b.l AND a.r = b.r AND a.word <> b.word
             UNION SELECT g.word, w.word FROM gap g JOIN w ON w.word = g.l || g.r
             UNION SELECT w.word, g.word FROM gap g JOIN w ON w.word = g.l || g.r),
    ranked AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k FROM pair JOIN w ON w.word = b),
    f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN ranked.n >= 5 * w.n THEN b END AS form, CASE WHEN ranked.n >= 5 * w.n THEN ranked.n END AS form_n
          FROM w LEFT JOIN ranked ON a = w.word AND k = 1),
    chain(word, tip) AS (SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.tip WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, chain.tip AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
    FROM f JOIN chain USING (word) JOIN f AS last ON last.word = chain.tip AND last.form IS NULL""",
)
def op13(spark, sf_dir):
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
