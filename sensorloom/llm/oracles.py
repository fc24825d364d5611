"""The queries of this subpackage that SQL can express, written from their rules."""

from __future__ import annotations

#: Levels of a manifest's trees that the SQL spells out: 8**8 rows for a lang, 8**3 langs.
LANG_LEVELS, ROOT_LEVELS = 8, 3
#: The reflected polynomial of crc32, and all ones.
POLYNOMIAL, ONES = 3988292384, 4294967295


def crc32(text: str) -> str:
    """crc32 of a text, unsigned, of which the bytes are ASCII or Latin-1 letters in UTF-8: every
    byte is followed by eight marks, each of which shifts one bit out."""
    code = "unicode(c)"
    octets = (
        f"CASE WHEN {code} < 128 THEN [{code}] ELSE [192 + ({code} >> 6), 128 + ({code} & 63)] END"
    )
    steps = (
        f"list_prepend(CAST({ONES} AS BIGINT), flatten(list_transform(flatten(list_transform("
        f"string_split({text}, ''), lambda c: {octets})), "
        "lambda b: [CAST(b AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])))"
    )
    step = f"CASE WHEN e >= 0 THEN xor(s, e) ELSE xor(s >> 1, (s & 1) * {POLYNOMIAL}) END"
    return f"xor(list_reduce({steps}, lambda s, e: {step}), {ONES})"


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    fields = " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


def _tree(name: str, source: str, levels: int) -> str:
    """CTEs ``{name}0`` to ``{name}{levels}`` with ``g, i, m, h`` and what stands beside each node
    in its run; ``m`` counts the nodes of the level. The first keeps the columns of the source."""
    around = (
        "coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i "
        "ROWS BETWEEN {} AND {}), '') AS {}"
    )
    sides = ", ".join(
        (
            around.format("UNBOUNDED PRECEDING", "1 PRECEDING", "l"),
            around.format("1 FOLLOWING", "UNBOUNDED FOLLOWING", "r"),
        )
    )
    parts = [f"{name}0 AS (SELECT *, {sides} FROM ({source}))"]
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS (SELECT *, {sides} FROM (SELECT g, i // 8 AS i, (m + 7) // 8 AS m, "
            "CASE WHEN m > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h "
            f"FROM {name}{k} GROUP BY g, i // 8, m))"
        )
    return ", ".join(parts)


def manifest() -> str:
    lang_tree = _tree("t", "SELECT g, i, m, leaf AS h FROM d", LANG_LEVELS)
    root_tree = _tree(
        "u",
        "SELECT 0 AS g, row_number() OVER (ORDER BY g IS NOT NULL, encode(g)) - 1 AS i, "
        f"count(*) OVER () AS m, h, g AS lang FROM t{LANG_LEVELS}",
        ROOT_LEVELS,
    )
    steps = [("t", k, f"p.i // {8**k}") for k in range(LANG_LEVELS)]
    steps += [("u", k, f"p.j // {8**k}") for k in range(ROOT_LEVELS)]
    folds, before = [], "p0"
    for number, (tree, k, at) in enumerate(steps):
        same = "x.g IS NOT DISTINCT FROM p.g AND " if tree == "t" else ""
        folds.append(
            f"p{number + 1} AS (SELECT p.* REPLACE ("
            "CASE WHEN x.m > 1 THEN sha256(x.l || p.f || x.r) ELSE p.f END AS f, "
            "CASE WHEN x.m > 1 THEN p.s || x.l || x.r ELSE p.s END AS s) "
            f"FROM p{number} AS p JOIN {tree}{k} AS x ON {same}x.i = {at})"
        )
    touched = f"doc_id IS NOT NULL AND {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0"
    return (
        "WITH d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        f"count(*) OVER (PARTITION BY g) AS m FROM (SELECT doc_id, lang AS g, {_leaf('text')} AS leaf, "
        f"CASE WHEN {touched} THEN {_leaf(LOWER.format('text'))} END AS changed FROM documents)), "
        f"{lang_tree}, {root_tree}, p0 AS (SELECT d.*, u0.i AS j, u0.h AS subroot, "
        "coalesce(changed, leaf) AS f, '' AS s FROM d JOIN u0 ON u0.lang IS NOT DISTINCT FROM d.g), "
        + ", ".join(folds)
        + f" SELECT doc_id, leaf, subroot, r.h AS root, sha256(s) AS proof_sha256, f AS folded_root, "
        f"f = r.h AS verified FROM p{len(steps)} CROSS JOIN (SELECT h FROM u{ROOT_LEVELS}) AS r"
    )


def spellings() -> str:
    run = LOWER.format("run")
    return (
        "WITH RECURSIVE runs AS (SELECT id, run, count(*) AS n FROM (SELECT doc_id AS id, "
        f"{run} AS run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run "
        "FROM documents)) GROUP BY 1, 2), "
        f"marked AS (SELECT run, n, {crc32("coalesce(CAST(id AS VARCHAR), '') || ':' || run")} AS h FROM runs), "
        "words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN "
        "run[:CAST(h % length(run) AS INT)] || run[CAST(h % length(run) AS INT) + 2:] ELSE run END AS word "
        "FROM marked) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3), "
        # words that lack one code point: equal to a word, or equal to another's with the same gap
        "gaps AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM "
        "(SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)), "
        "pairs AS (SELECT a.word, b.word AS other FROM gaps AS a JOIN gaps AS b USING (rest, i) "
        "WHERE a.word <> b.word UNION SELECT g.word, w.word FROM gaps AS g JOIN words AS w ON w.word = g.rest "
        "UNION SELECT w.word, g.word FROM gaps AS g JOIN words AS w ON w.word = g.rest), "
        "best AS (SELECT p.word, count(*) AS n_near, "
        "arg_min(other, (-o.n, encode(other))) AS form, max(o.n) AS form_n "
        "FROM pairs AS p JOIN words AS o ON o.word = p.other GROUP BY p.word), "
        "forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, "
        "CASE WHEN form_n >= 2 * w.n THEN form END AS form, "
        "CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM words AS w LEFT JOIN best USING (word)), "
        "ways AS (SELECT word, word AS at FROM forms UNION ALL "
        "SELECT ways.word, f.form FROM ways JOIN forms AS f ON f.word = ways.at WHERE f.form IS NOT NULL) "
        "SELECT forms.word, forms.form, ways.at AS root, forms.n, forms.n_near, forms.form_n FROM forms "
        "JOIN ways USING (word) JOIN forms AS e ON e.word = ways.at WHERE e.form IS NULL"
    )


def substrings(window: int = 50) -> str:
    return (
        r"WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents), "
        "p AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + "
        f"{window - 1} <= len(w) THEN sha256(array_to_string(w[i:i + {window - 1}], ' ')) END AS h "
        "FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)), "
        "f AS (SELECT h, min(doc_id) AS least FROM p WHERE h IS NOT NULL GROUP BY h), "
        "c AS (SELECT doc_id, i, word, coalesce(max(CASE WHEN least < doc_id THEN 1 ELSE 0 END) OVER "
        f"(PARTITION BY doc_id ORDER BY i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW), 0) AS gone "
        "FROM p LEFT JOIN f USING (h)) "
        "SELECT d.doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, CAST(coalesce(sum(gone), 0) AS BIGINT) AS n_removed, "
        "sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256 "
        "FROM d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id"
    )


def archive() -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    four = " || ".join(f"{letters}[(v >> {bits} & 31) + 1]" for bits in (15, 10, 5, 0))
    digest = (
        "array_to_string(list_transform(list_transform(range(8), "
        f"lambda k: CAST('0x' || sha1(payload)[5 * k + 1:5 * k + 5] AS BIGINT)), lambda v: {four}), '')"
    )
    return (
        "WITH r AS (SELECT page_id, coalesce(html, '') AS payload, "
        "max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages) "
        "SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, "
        f"{digest} AS payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type, "
        "CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM r"
    )


def embeddings(least: float = 0.9) -> str:
    return (
        "WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings "
        "WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
        "AND len(list_filter(embedding, lambda x: x <> 0)) > 0), "
        "links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b "
        "ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) "
        f"WHERE list_cosine_similarity(a.e, b.e) >= {least}), "
        "reached AS (SELECT vec_id AS a, vec_id AS b FROM v UNION "
        "SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b), "
        "roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a), "
        "counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) "
        "SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id, "
        "e.vec_id = coalesce(component_id, e.vec_id) AS kept FROM embeddings AS e "
        "LEFT JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)"
    )


ORACLES: dict[str, str] = {
    "op6_substrings": substrings(),
    "op9_warc": archive(),
    "op10_embeddings": embeddings(),
    "op12_manifest": manifest(),
    "op13_spellings": spellings(),
}
