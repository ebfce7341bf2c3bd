"""DuckDB SQL for the queries that it can express. The others are tested against brute force."""

from __future__ import annotations

from txflow.llm.licenses import NOT_WORD, PHRASES, known_templates

_URLS = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                       THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
"""

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


def _licenses() -> str:
    def listing(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    places = " || ".join(
        f"list_transform(list_filter(range(len(w)), lambda i: w[i + 1:i + {len(p.split(' '))}] = {listing(p.split(' '))}), "
        f"lambda i: {{'word': i, 'label': '{label}'}})" for p, label in PHRASES.items())
    templates = [f"('{t['label']}', '{t['family']}', {t['run']}, {listing(t['words'])}, {t['need']})" for t in known_templates()]
    split = f"list_filter(regexp_split_to_array(lower({{}}), '{NOT_WORD}'), lambda x: x <> '')"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {split.format("coalesce(text, '')")} AS w FROM documents),
templates(label, family, run, words, need) AS (VALUES {", ".join(templates)}),
base AS (SELECT doc_id, w, len(w) AS n_words, {places} AS places FROM docs),
likely AS (SELECT doc_id, w, templates.* FROM base JOIN templates ON len(list_intersect(list_distinct(w), words)) >= need),
runs AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM likely),
shared AS (SELECT doc_id, label, family, i, len(words) AS n, need, len(list_intersect(list_distinct(w[i:i + run - 1]), words)) AS s
           FROM runs WHERE list_contains(words, w[i])),
won AS (SELECT * FROM shared WHERE s >= need
        QUALIFY row_number() OVER (PARTITION BY doc_id, family, i ORDER BY s / n DESC, n DESC, label) = 1),
fits AS (SELECT doc_id, list(DISTINCT label) AS found, max(s / n) AS share FROM won GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base,
       list_min(list_transform(places, lambda p: p.word))::BIGINT AS first_word,
       list_max(list_transform(places, lambda p: p.word))::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label) || coalesce(found, []))), ','), '') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM base LEFT JOIN fits USING (doc_id)
"""


_COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
worded AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
ngrams AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0),
f AS (SELECT lang, w[i:i + k] AS g, count(*) AS c FROM ngrams, (SELECT unnest(range(0, 5)) AS k) AS ks
      WHERE i + k <= len(w) GROUP BY ALL),
sizes AS (SELECT lang, sum(c)::HUGEINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT lang, g, c AS a FROM f WHERE len(g) > 1 AND c >= 100),
inside AS (SELECT lang, a, g[i:i + k] AS g FROM (
             SELECT lang, g, a, unnest(range(1, len(g))) AS i, k FROM candidates, (SELECT unnest(range(1, 4)) AS k) AS ks)
           WHERE i + k <= len(g)
           UNION ALL SELECT lang, a, g[2:] FROM candidates),
dropped AS (SELECT DISTINCT c.lang, c.g FROM candidates c JOIN inside i ON i.lang = c.lang AND i.g = c.g AND 100 * i.a >= 100 * c.a
            WHERE len(c.g) < 5 AND EXISTS (SELECT 1 FROM candidates x WHERE x.lang = c.lang AND len(x.g) > len(c.g) AND x.a >= c.a
              AND list_contains(list_transform(range(1, len(x.g) - len(c.g) + 2), lambda j: x.g[j:j + len(c.g) - 1] = c.g), true))),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates ANTI JOIN dropped USING (lang, g)),
scored AS (
  SELECT c.lang, c.g, c.a, x.c AS l, y.c AS r, n, c.k,
         (1000::HUGEINT * c.a * n) // (x.c::HUGEINT * y.c) AS score
  FROM cuts c JOIN sizes USING (lang) JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, c.k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' '))::INTEGER AS rank,
       array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM scored QUALIFY rank <= 2000
"""


SQL: dict[str, str] = {"op1_url_filters": _URLS, "op4_topk": _TOP_K, "op8_licenses": _licenses(), "op11_collocations": _COLLOCATIONS}
