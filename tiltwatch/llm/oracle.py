"""SQL counterparts of the operators' queries, for those that SQL can express."""

from __future__ import annotations

from tiltwatch.llm.queries import SHARD_BYTES, URL_RULES
from tiltwatch.llm.urls import DAMPING, MARGIN, ROUNDS

_WORD = r"[^\x20\x09-\x0D]+"


def _sharding() -> str:
    """Every prefix of every length with its bytes; a row's shard is its shortest prefix that fits."""
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
            ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
        FROM documents
    ), p AS (
        SELECT doc_id, bytes, depth, h >> (60 - depth) AS prefix FROM d, (SELECT unnest(range(61)) AS depth)
    ), s AS (
        SELECT depth, prefix, sum(bytes)::BIGINT AS held, count(*) AS n FROM p GROUP BY depth, prefix
    ), f AS (
        SELECT p.doc_id, p.bytes, p.depth, p.prefix, s.held FROM p JOIN s USING (depth, prefix)
        WHERE held <= {SHARD_BYTES} OR n = 1 OR depth = 60
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
    )
    SELECT doc_id, CASE WHEN depth = 0 THEN 'root' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
        bytes, held AS shard_bytes
    FROM f
    """


def _decontamination() -> str:
    """Every shingle of every item against every shingle of every document."""
    words = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
    WITH i AS (
        SELECT DISTINCT item_id, {words} AS w, least(5, len({words})) AS k FROM benchmark
    ), s AS (
        SELECT DISTINCT item_id, w, k, array_to_string(w[pos:pos + k - 1], ' ') AS shingle
        FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS pos FROM i WHERE k > 0)
    ), n AS (
        SELECT *, count(*) OVER (PARTITION BY item_id, w) AS n_shingles FROM s
    ), d AS (
        SELECT DISTINCT doc_id, text, {words} AS w FROM documents
    ), g AS (
        SELECT DISTINCT doc_id, text, k, array_to_string(w[pos:pos + k - 1], ' ') AS shingle
        FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS pos FROM d, (SELECT DISTINCT k FROM i WHERE k > 0))
    )
    SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
    FROM g JOIN n USING (k, shingle)
    GROUP BY doc_id, text, item_id, n.w, n_shingles
    HAVING count(*) >= n_shingles * 0.8 - 1e-9
    """


def _url_filters() -> str:
    """Rules by length; the walks over host links with each round as a table of its own."""
    rules = ", ".join(f"('{h}', '{p}', '{h}{p}', '{v}')" for h, p, v in URL_RULES)
    link = r"""(?i)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)"""
    rounds = []
    for n in range(1, ROUNDS + 1):
        rounds.append(f"""
    r{n} AS MATERIALIZED (
        SELECT v.kind, v.host, v.seed, v.stays,
            {1 - DAMPING} * v.seed + {DAMPING} * (coalesce(g.got, 0) + CASE WHEN v.stays THEN v.score ELSE 0 END)
                AS score
        FROM r{n - 1} v LEFT JOIN (
            SELECT w.kind, w.dst AS host, sum(p.score * w.share) AS got
            FROM r{n - 1} p JOIN w ON w.kind = p.kind AND w.src = p.host GROUP BY w.kind, w.dst
        ) g USING (kind, host)
    )""")
    return rf"""
    WITH rules(rule_host, rule_path, rule, said) AS (VALUES {rules}),
    u AS (
        SELECT page_id, html, row_number() OVER () AS id,
            coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), fit AS (
        SELECT id, rule, said FROM u JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(rule) DESC) = 1
    ), j AS (
        SELECT u.*, rule, said FROM u LEFT JOIN fit USING (id)
    ), seeds AS (
        SELECT host, avg(CASE WHEN said = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
            avg(CASE WHEN said = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
        FROM j WHERE host <> '' GROUP BY host
    ), l AS (
        SELECT src, dst, count(*) AS links FROM (
            SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM u
        ) WHERE src <> '' AND src <> dst GROUP BY src, dst
    ), w AS MATERIALIZED (
        SELECT 'trust' AS kind, src, dst, links / sum(links) OVER (PARTITION BY src) AS share FROM l
        UNION ALL
        SELECT 'distrust', dst, src, links / sum(links) OVER (PARTITION BY dst) FROM l
    ), h AS (
        SELECT host FROM seeds UNION SELECT src FROM l UNION SELECT dst FROM l
    ), r0 AS MATERIALIZED (
        SELECT kind, host, seed, seed AS score,
            NOT EXISTS (SELECT 1 FROM w WHERE w.kind = a.kind AND w.src = a.host) AS stays
        FROM (
            SELECT 'trust' AS kind, host, coalesce(trust, 0.0) AS seed FROM h LEFT JOIN seeds USING (host)
            UNION ALL SELECT 'distrust', host, coalesce(distrust, 0.0) FROM h LEFT JOIN seeds USING (host)
        ) a
    ), {", ".join(rounds)}
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN (
            SELECT sum(CASE WHEN kind = 'distrust' THEN score ELSE -score END) FROM r{ROUNDS} WHERE r{ROUNDS}.host = j.host
        ) > {MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
    FROM j
    """


def _repetition() -> str:
    """Counts by unnesting words and lines; windows by joining their words."""
    from tiltwatch.llm.repetition import LIMITS, LINE_LIMIT

    windows = " UNION ALL ".join(
        f"""SELECT id, {k} AS k, pos, CASE WHEN count(*) OVER (PARTITION BY id, array_to_string(w[pos:pos + {k - 1}], ' '))
            > 1 THEN 1 ELSE 0 END AS twice FROM (SELECT id, w, unnest(range(1, len(w) - {k - 2})) AS pos FROM d)"""
        for k in (3, *LIMITS)
    )
    over = " OR ".join(f"coalesce(c{k}, 0) > {limit} * word_chars" for k, limit in LIMITS.items())
    cover = ", ".join(f"sum(len(w[i])) FILTER (WHERE k = {k}) AS c{k}" for k in LIMITS)
    return rf"""
    WITH d AS (
        SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
    ), t AS (
        SELECT * FROM ({windows}) WHERE twice = 1
    ), inside AS (
        SELECT DISTINCT id, k, unnest(range(pos, pos + k)) AS i FROM t
    ), c AS (
        SELECT id, count(*) FILTER (WHERE k = 3) AS n_repeat_words, {cover}
        FROM inside JOIN d USING (id) GROUP BY id
    ), l AS (
        SELECT id, count(*) AS n_dup_lines, sum(chars) AS dup_line_chars FROM (
            SELECT id, len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
                row_number() OVER (PARTITION BY id, line) AS nth
            FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM d)
        ) WHERE chars > 0 AND nth > 1 GROUP BY id
    ), m AS (
        SELECT id, doc_id, len(w)::BIGINT AS n_words, len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
        FROM d
    ), a AS (
        SELECT *, coalesce(n_dup_lines, 0) AS dup, coalesce(n_repeat_words, 0) AS rep,
            n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
        FROM m LEFT JOIN c USING (id) LEFT JOIN l USING (id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, dup AS n_dup_lines, rep AS n_repeat_words, base_failed,
        NOT base_failed AND NOT (coalesce(dup_line_chars, 0) > {LINE_LIMIT} * word_chars OR {over}) AS kept
    FROM a
    """


def _mixing() -> str:
    """Targets from running sums, Sainte-Laguë quotients ranked over a wide range, documents in md5 order."""

    def seats(parties: str, groups: str, key: str, weight: str, blocks: str) -> str:
        return f"""
            SELECT p.*, (SELECT count(*) FROM (
                SELECT g, k FROM (
                    SELECT {groups} AS g, {key} AS k, {weight} AS x, {blocks} AS b,
                        {weight} / (2 * unnest(range(1, ({blocks} + 1)::BIGINT)) - 1) AS q
                    FROM {parties} WHERE {weight} > 0
                ) QUALIFY row_number() OVER (PARTITION BY g ORDER BY q DESC, k) <= b
            ) r WHERE r.g = p.{groups} AND r.k = p.{key}) AS quota
            FROM {parties} p"""

    return rf"""
    WITH d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
            ('0x' || substr(md5('mix-0' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), '') || chr(31)
                || coalesce(text, '')), 1, 15))::BIGINT AS h
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size, 0 AS every,
            row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source
    ), x AS (
        SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(number - 1) % 3 + 1] AS weight,
            (source_size * 2)::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS pool FROM s
    ), y AS (
        SELECT *, most / weight AS ratio, (pool - coalesce(sum(most) OVER (ORDER BY most / weight, number
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM x
    ), z AS (
        SELECT *, (SELECT arg_min(level, number + 1e9 * rank) FROM (
            SELECT *, row_number() OVER (ORDER BY ratio, number) AS rank FROM y) WHERE level <= ratio) AS stop FROM y
    ), t AS MATERIALIZED (
        SELECT source, number, source_size, every, pool, CASE WHEN stop IS NULL THEN most ELSE least(most, stop * weight) END
            AS target, floor(pool / 32 + 0.5)::BIGINT AS blocks FROM z
    ), q AS MATERIALIZED ({seats("t", "every", "number", "target", "blocks")}
    ), b AS (
        SELECT number, shard, sum(size)::BIGINT AS words, any_value(quota) AS source_blocks FROM (
            SELECT q.number, q.quota, d.size, d.h % greatest(1, ceil(source_size / 1000000)::BIGINT) AS shard
            FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
        ) GROUP BY number, shard
    ), c AS MATERIALIZED (SELECT * FROM b
    ), e AS MATERIALIZED ({seats("c", "number", "shard", "words", "source_blocks")}
    ), o AS (
        SELECT d.doc_id, d.size, q.source_size, q.target, e.quota * 32 AS tokens, e.words,
            sum(d.size) OVER (PARTITION BY q.number, e.shard ORDER BY d.h, d.doc_id, d.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
        FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
        JOIN e ON e.number = q.number AND e.shard = d.h % greatest(1, ceil(q.source_size / 1000000)::BIGINT)
    ), f AS (
        SELECT *, CASE WHEN words > 0 THEN least(2, tokens // words) ELSE 0 END AS whole FROM o
    )
    SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(until,
        CASE WHEN whole < 2 THEN tokens - whole * words ELSE 0 END) - (until - size)))::BIGINT AS taken
    FROM f
    """


def _centroids(k: int = 40, dims: int = 64, rounds: int = 5) -> str:
    """Every vector against every centroid, round by round."""

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
        SELECT any_value(k.vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': CAST(list_inner_product(k.v, k.v)
            + list_inner_product(c.v, c.v) - 2 * list_inner_product(k.v, c.v) AS BIGINT), 'c': c.c}}) AS m
        FROM kept k CROSS JOIN c{i} c GROUP BY k.rid)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
        SELECT old.c, coalesce(new.v, old.v) AS v FROM c{i} old LEFT JOIN (
            SELECT c, list(x ORDER BY i) AS v FROM (
                SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS DOUBLE) AS x
                FROM (SELECT m.c AS c, unnest(range({dims})) AS i, CAST(unnest(v) AS BIGINT) AS x FROM a{i})
                GROUP BY c, i
            ) GROUP BY c
        ) new ON old.c = new.c)"""

    steps = ",\n    ".join(f"{assigned(i)},\n    {moved(i)}" for i in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, vec_id,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}
    ), c0 AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, v
        FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k})
    ), {steps},
    {assigned(rounds)}
    SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance,
        CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
        sha256(list_aggregate(list_transform(f.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ','))
            AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} f ON f.c = m.c
    """


def _extraction() -> str:
    """The given pages have one layout, so their article can be named; templates are tested apart."""
    return r"""
    WITH blocks AS (
        SELECT page_id, url, string_split_regex(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?(p|h1)>') AS b
        FROM pages
    ), decoded AS (
        SELECT page_id, url, list_transform(b, lambda x: trim(regexp_replace(
            replace(regexp_replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
                '&quot;?', '"', 'g'), '&amp;', '&amp'), '\s+', ' ', 'g'))) AS b
        FROM blocks
    ), t AS (
        SELECT page_id, url, replace(array_to_string(list_filter(b, lambda x: x <> ''), chr(10)), '&amp', '&') AS text
        FROM decoded
    )
    SELECT page_id, url, text, length(text) AS n_chars FROM t
    """


def _spelling() -> str:
    """Near words share a text with one code point deleted; checksums come from their table."""
    return r"""
    WITH RECURSIVE crc AS MATERIALIZED (
        SELECT list(list_reduce(range(8), lambda c, _:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
        FROM (SELECT unnest(range(256)) AS b)
    ), runs AS MATERIALIZED (
        SELECT id, run, count(*) AS n FROM (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
            FROM documents
        ) WHERE length(run) >= 7 GROUP BY ALL
    ), hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(
            list_transform(range(octet_length(b)), lambda i:
                CAST('0x' || substr(hex(b), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) AS h
        FROM (SELECT run, n, encode(id || ':' || run) AS b FROM runs), crc
    ), words AS MATERIALIZED (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT n, CASE WHEN h % 31 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM hashed
        ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ), cut AS MATERIALIZED (
        SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
    ), near AS MATERIALIZED (
        SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
        UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word
    ), led AS MATERIALIZED (
        SELECT near.a AS word, count(*) AS n_near, min({'less': -other.n, 'word': other.word}) AS best
        FROM near JOIN words other ON other.word = near.b GROUP BY near.a
    ), forms AS MATERIALIZED (
        SELECT word, best.word AS form, -best.less AS form_n, n_near, -best.less >= 10 * n AS common
        FROM led JOIN words USING (word)
    ), walk AS (
        SELECT word, word AS now FROM words
        UNION ALL SELECT walk.word, form FROM walk JOIN forms ON forms.word = walk.now AND common
    ), ends AS (
        SELECT walk.word, now FROM walk LEFT JOIN forms ON forms.word = walk.now AND common WHERE forms.word IS NULL
    )
    SELECT words.word, CASE WHEN common THEN form END AS form, ends.now AS root, words.n,
        coalesce(n_near, 0) AS n_near, CASE WHEN common THEN form_n END AS form_n
    FROM words JOIN ends ON ends.word = words.word LEFT JOIN forms ON forms.word = words.word
    """


def all_sql() -> dict[str, str]:
    return {
        "op1_sharding": _sharding(),
        "op4_decontamination": _decontamination(),
        "op5_url_filters": _url_filters(),
        "op6_repetition": _repetition(),
        "op8_mixing": _mixing(),
        "op11_centroids": _centroids(),
        "op12_extraction": _extraction(),
        "op13_spelling": _spelling(),
    }
