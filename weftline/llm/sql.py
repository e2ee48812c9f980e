"""DuckDB SQL that the registered queries must agree with, where SQL can express them."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def mixing_parts(docs: str) -> str:
    """Common tables d, s, t, l over the named documents: sizes, source weights, the level to which all are filled."""
    return f"""
    d AS (SELECT *, len({_BLANK})::BIGINT AS size FROM {docs}),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS nth
          FROM d GROUP BY source),
    w AS (SELECT *, [5, 2, 1][(nth - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
    f AS (SELECT *, cap::DOUBLE / weight AS fill,
                 (sum(source_size) OVER ())::BIGINT
                 - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
                 (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights FROM w),
    l AS (SELECT rest::DOUBLE / weights AS level FROM f WHERE rest::DOUBLE / weights <= fill ORDER BY fill, nth LIMIT 1),
    t AS (SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM f, l),
    m AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
                 ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS coin
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    mixed AS (SELECT *, (floor(rate) + (coin < rate - floor(rate))::INT)::BIGINT AS copies FROM m)"""


def quality_parts(docs: str) -> str:
    """Common tables up to ``judged`` over the named documents: measures, verdict and the cleaned text of every row."""
    return rf"""
    q AS (SELECT *, row_number() OVER () AS r, {_BLANK} AS w FROM {docs}),
    ln AS (SELECT r, source, text, k, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
                  trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
           FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM q)),
    often AS (SELECT source, norm, count(DISTINCT text) AS c FROM ln WHERE n > 0 GROUP BY 1, 2 HAVING c >= 3),
    hosts AS (SELECT source, count(DISTINCT coalesce(text, '')) AS texts FROM q GROUP BY 1),
    freq AS (SELECT o.source, norm FROM often o JOIN hosts h ON o.source IS NOT DISTINCT FROM h.source WHERE c > 0.05::DOUBLE * texts),
    marked AS (SELECT ln.*, f.norm IS NOT NULL AND n > 0 AS gone FROM ln LEFT JOIN freq f ON ln.norm = f.norm AND ln.source IS NOT DISTINCT FROM f.source),
    clean AS (SELECT r, coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS n_removed_words, bool_or(gone) AS any_gone,
                     coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS rest,
                     (count(*) FILTER (WHERE n > 0) - count(DISTINCT l) FILTER (WHERE n > 0))::BIGINT AS n_dup_lines FROM marked GROUP BY r),
    w3 AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM q WHERE len(w) >= 3)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM w3) WHERE c > 1),
    rep AS (SELECT r, count(DISTINCT i + o)::BIGINT AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
    base AS (SELECT q.*, len(w)::BIGINT AS n_words,
                    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_words, 0) AS n_removed_words,
                    CASE WHEN any_gone THEN rest ELSE text END AS clean_text
             FROM q LEFT JOIN clean USING (r) LEFT JOIN rep USING (r)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                      NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_removed_words <= 80 * n_words AS kept FROM base)"""


_CONTAMINATION = f"""
    WITH b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_PLAIN} AS w FROM benchmark),
    win AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    d AS (SELECT doc_id, row_number() OVER () AS r, {_PLAIN} AS w FROM documents),
    dw AS (SELECT r, k, i, list_slice(w, i, i + k - 1) AS win
           FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT len(win) AS k FROM win) WHERE len(w) >= k)),
    hit AS (SELECT r, i, k, item FROM dw JOIN win USING (win)),
    places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)"""

_REPEATS = rf"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_BLANK} AS w FROM documents),
    win AS (SELECT r, doc_id, i, list_slice(w, i, i + 49) AS win FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
    hashed AS (SELECT r, doc_id, i, md5(array_to_string(win, ' ')) AS h FROM win),
    later AS (SELECT r, i FROM hashed JOIN (SELECT h, min(doc_id) AS first FROM hashed GROUP BY h) USING (h) WHERE first < doc_id),
    gone AS (SELECT DISTINCT r, i + o AS p FROM later, (SELECT unnest(range(0, 50)) AS o)),
    words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (SELECT words.r, string_agg(word, ' ' ORDER BY words.p) AS body, count(*) AS n FROM words
             LEFT JOIN gone ON words.r = gone.r AND words.p = gone.p WHERE gone.r IS NULL GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text of letters up to code point 255, bit by bit: an entry of a list is a byte, or -1 for a shift."""
    codes = f"[ord(c) for c in string_split({text}, '')]"
    octets = f"flatten([CASE WHEN c < 128 THEN [c] ELSE [195, c - 64] END for c in {codes}])"
    steps = f"flatten([[b::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for b in {octets}])"
    step = "CASE WHEN e >= 0 THEN xor(crc, e) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda crc, e: {step}), 4294967295)"


_SPELLING = rf"""
    WITH RECURSIVE
    runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    hashed AS (SELECT run, {_crc32("id || ':' || run")} AS h FROM runs WHERE length(run) >= 7),
    cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
    words AS MATERIALIZED (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2),
    less AS MATERIALIZED (SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
              UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
              UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
    best AS (SELECT p.word, count(*) AS n_near, first(w.word ORDER BY w.n DESC, w.word) AS other, max(w.n) AS other_n FROM pairs p JOIN words w ON w.word = p.other GROUP BY 1),
    forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
                                  CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
    walk AS (SELECT word, form AS far, 1 AS step FROM forms WHERE form IS NOT NULL
             UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN forms f ON f.word = walk.far WHERE f.form IS NOT NULL),
    ends AS (SELECT word, last(far ORDER BY step) AS root FROM walk GROUP BY 1)
    SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM forms LEFT JOIN ends USING (word)"""

_TRIE = rf"""
    WITH turns AS (SELECT conv_id, turn, len({_BLANK}) AS words, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
                   FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS p, list(words ORDER BY turn NULLS FIRST, digest) AS w, ({_crc32("conv_id::VARCHAR")} % 4)::INT AS h FROM turns GROUP BY 1),
    whole AS (SELECT a.conv_id, list_concat(list_slice(coalesce(b.p, []), 1, a.h), list_slice(a.p, a.h + 1, len(a.p))) AS p,
                     list_concat(list_slice(coalesce(b.w, []), 1, a.h), list_slice(a.w, a.h + 1, len(a.w))) AS w
              FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
    prefix AS (SELECT conv_id, len(p) AS turns, d, list_slice(p, 1, d) AS node, CASE WHEN d = 0 THEN 0 ELSE w[d] END AS words
               FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM whole)),
    nodes AS MATERIALIZED (SELECT node, d, list_slice(node, 1, d - 1) AS above, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * min(words) AS saved,
                     sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE turns = d), '')) AS ends FROM prefix GROUP BY node, d),
    kids AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
    own_sums AS MATERIALIZED (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
    sums AS (SELECT list_slice(node, 1, a) AS node, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
             FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_sums) GROUP BY 1)
    SELECT s.conv_id, s.d::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n AS n_convs, s.n_children, n_leaves, saved_tokens, s.ends AS ends_sha256
    FROM own_sums s JOIN sums USING (node) LEFT JOIN own_sums p ON s.d > 0 AND p.node = s.above"""

_TOPK = """
    WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS q FROM embeddings
                            WHERE vec_id IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    w AS MATERIALIZED (SELECT r, vec_id, list_resize(q, (SELECT max(len(q)) FROM v), 0.0) AS q FROM v),
    scores AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, coalesce(list_sum([x[1] * x[2] for x in list_zip(a.q, b.q)]), 0)::BIGINT AS score FROM w a JOIN w b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scores)
    SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": _CONTAMINATION,
    "op5_mix_sources": f"WITH {mixing_parts('documents')}\n    SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed",
    "op7_substring_dedup": _REPEATS,
    "op11_spelling_variants": _SPELLING,
    "op12_conversation_trie": _TRIE,
    "op13_exact_topk": _TOPK,
    "op6_quality_rules": f"WITH {quality_parts('documents')}\n    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words FROM judged",
}
