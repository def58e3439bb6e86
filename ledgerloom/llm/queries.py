"""Queries of the training-data operators and their DuckDB twins, for the entry module."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann
from .common import table
from .decontaminate import find_leaks
from .html_extract import extract_main
from .language_id import identify
from .license_scan import known_digests, scan_licenses
from .line_dedup import dedup_lines
from .near_dedup import near_duplicates
from .packing import pack_documents
from .secret_scan import scan_secrets
from .url_filter import filter_urls, rule_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_patience_line_dedup(spark, sf_dir):
    """Every document with its text less the passages it shares with earlier ones, and what went; odd rows as in ``dedup_lines``."""
    cut = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    span = F.transform("_cut.spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return cut.select(
        "doc_id", "text", F.coalesce("_cut.lines", F.lit(0)).alias("cut_lines"), F.coalesce("_cut.words", F.lit(0)).alias("cut_words"),
        F.coalesce("_cut.partners", F.array().cast("array<bigint>")).alias("partners"), F.coalesce(F.array_join(span, ","), F.lit("")).alias("cut_spans"),
    )


def op2_secret_ledger(spark, sf_dir):
    """Secrets of every document through a new ledger; odd rows as in ``scan_secrets``."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op3_ivf_pq_neighbours(spark, sf_dir):
    """The five nearest of every 50th vector among all; odd rows as in ``search``."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


def op4_latent_decontamination(spark, sf_dir):
    """A row per document and benchmark item it holds; odd rows as in ``find_leaks``."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("version")


def op5_license_digests(spark, sf_dir):
    """Every document's canonical digest and the licence that has it; odd rows as in ``scan_licenses``."""
    return scan_licenses(table(spark, sf_dir, "documents"), known_digests(spark))


def op6_fast_similarity_sketch(spark, sf_dir):
    """Every document's set size and group; odd rows as in ``near_duplicates``."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_string_kernel_language(spark, sf_dir):
    """Every document's predicted language; odd rows as in ``identify``."""
    return identify(table(spark, sf_dir, "documents"))


def op8_union_free_wrappers(spark, sf_dir):
    """Every page's main text; odd rows as in ``extract_main``."""
    return extract_main(table(spark, sf_dir, "pages"))


def op9_karmarkar_karp_packing(spark, sf_dir):
    """Every document's pieces in sequences of 4096; odd rows as in ``pack_documents``."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_url_rules(spark, sf_dir):
    """Every page's host, path, rule and verdict; odd rows as in ``filter_urls``."""
    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark))


QUERIES = {
    f.__name__: f
    for f in (
        op1_patience_line_dedup, op2_secret_ledger, op3_ivf_pq_neighbours, op4_latent_decontamination, op5_license_digests,
        op6_fast_similarity_sketch, op7_string_kernel_language, op8_union_free_wrappers, op9_karmarkar_karp_packing, op10_url_rules,
    )
}
ORACLES: dict[str, str] = {}


# ---------------------------------------------------------------- DuckDB twins


def _either_case(pattern: str, words: str) -> str:
    """``words`` in ``pattern`` with each letter as a class of both cases."""
    return pattern.replace(words, "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words))


def _secrets_sql() -> str:
    from .secret_scan import ACCESS, ASSIGN, MIN_ACCESS, MIN_HEX, MIN_VALUE

    words = "password|passwd|secret|token|api_?key"
    assign = _either_case(ASSIGN, words).replace("'", "''")
    kinds = [("assign", assign, "regexp_extract_all(t, '{p}', 2)", MIN_VALUE), ("access", ACCESS, "regexp_extract_all(t, '{p}')", MIN_ACCESS), ("hex", f"[0-9a-f]{{{MIN_HEX},}}", "regexp_extract_all(t, '{p}')", MIN_HEX)]
    parts = " UNION ALL ".join(
        f"SELECT rid, {i} AS place, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{p}') AS m, {value.format(p=p)} AS v, string_split_regex(t, '{p}') AS s FROM d"
        for i, (kind, p, value, least) in enumerate(kinds)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
k AS ({parts}),
u AS (SELECT rid, place, kind, least, m, v, s, unnest(range(1, len(m) + 1)) AS i FROM k),
f AS (SELECT rid, place, kind, length(m[i]) AS n,
             list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
      FROM u WHERE length(v[i]) >= least),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS na, count(*) FILTER (kind = 'access') AS nk, count(*) FILTER (kind = 'hex') AS nh,
             string_agg(kind || ':' || CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(a + n AS BIGINT) AS VARCHAR), ',' ORDER BY a, place) AS spans
      FROM f GROUP BY rid)
SELECT doc_id, coalesce(na, 0) AS n_assign, coalesce(nk, 0) AS n_access, coalesce(nh, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""


def _licenses_sql() -> str:
    """Its own normaliser; known texts go through it, so that nothing but the lists is shared with the operator."""
    from .license_digests import DIGESTS
    from .license_scan import PHRASES, SPELLINGS
    from .license_texts import KNOWN, TITLES

    def quoted(t: str) -> str:
        return "'" + t.replace("'", "''") + "'"

    spellings = "MAP {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in SPELLINGS.items()) + "}"
    lines = "regexp_replace(lower(replace(replace(t, chr(13) || chr(10), chr(10)), chr(304), 'i')), '(?m)^[ \\t]*((portions )?copyright\\b[ \\t]*(\\(c\\)|©|[0-9]|[<\\[{]|by\\b)|\\(c\\)[ \\t]|©|all rights reserved)[^\\n]*$', ' ', 'g')"
    marks = f"regexp_replace({lines}, '(?m)^[ \\t]*([0-9]{{1,2}}[.)]|\\([0-9a-z]{{1,2}}\\)|[a-z][.)]|[*•·-])[ \\t]+', ' ', 'g')"
    words = f"trim(regexp_replace({marks}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    form = f"' ' || array_to_string(list_transform(string_split({words}, ' '), lambda w: coalesce(spell.m[w], w)), ' ') || ' '"
    for old, new in PHRASES:
        form = f"replace({form}, ' {old} ', ' {new} ')"
    texts = ", ".join(f"({quoted(t)}, {quoted(n)})" for n, text in KNOWN.items() for t in [text, *(f"{title}\n\n{text}" for title in TITLES.get(n, []))])
    digests = ", ".join(f"('{d}', {quoted(n)})" for n, listed in DIGESTS.items() for d in listed)
    return f"""
WITH spell AS (SELECT {spellings} AS m),
k0(t, name) AS (VALUES {texts}),
k AS (SELECT digest, min(name) AS license FROM (SELECT sha256(trim({form})) AS digest, name FROM k0, spell UNION ALL SELECT * FROM (VALUES {digests}) AS v(digest, name)) GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
c AS (SELECT doc_id, trim({form}) AS form FROM d, spell)
SELECT doc_id, sha256(form) AS digest, license, CAST(length(form) AS INTEGER) AS n_canonical FROM c LEFT JOIN k ON sha256(form) = k.digest"""


def _urls_sql() -> str:
    from .url_filter import RULES

    fits = lambda host, path: f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    longest = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest)
    return f"""
WITH p AS (SELECT page_id,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE 'allow' END AS verdict FROM p"""


ORACLES |= {"op2_secret_ledger": _secrets_sql(), "op5_license_digests": _licenses_sql(), "op10_url_rules": _urls_sql()}
