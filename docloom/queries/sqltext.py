"""SQL fragments shared by the checks (DuckDB dialect)."""

from __future__ import annotations


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def normalized(x: str) -> str:
    return rf"regexp_replace({strip(f'lower({x})')}, '\s+', ' ', 'g')"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower(coalesce({x}, '')), '[\p{{L}}\p{{N}}_]+')"


def sid(*parts: str) -> str:
    joined = " || '::' || ".join(f"coalesce(({p})::VARCHAR, '')" for p in parts)
    return f"substr(sha256({joined}), 1, 24)"


def preview(x: str, n: int = 220) -> str:
    return f"replace(substr(coalesce({x}, ''), 1, {n}), chr(10), ' ')"


def overlap(q: str, c: str) -> str:
    return f"(len(list_intersect(list_distinct({words(q)}), {words(c)})) / len(list_distinct({words(q)})))"


def d2(a: str, b: str) -> str:
    return (f"round(list_sum(list_transform(list_zip({a}, {b}), "
            "lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2)), 9)")


def vectors(name: str, source: str, key: str, text: str) -> str:
    """CTEs ``name(key, v)``: hashed count vectors of a text column at unit length."""
    return f"""
    {name}_b AS (SELECT {key}, list_transform({words(text)},
        lambda t: (('0x' || substr(md5(t), 1, 8))::UBIGINT % 64)::BIGINT) AS b FROM {source}),
    {name}_c AS (SELECT {key}, list_transform(range(64), lambda d: len(list_filter(b, lambda x: x = d))) AS c
        FROM {name}_b),
    {name}_n AS (SELECT {key}, c, sqrt(list_sum(list_transform(c, lambda x: x * x))::DOUBLE) AS n FROM {name}_c),
    {name} AS (SELECT {key}, list_transform(c, lambda x: (x / (CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE n END))::FLOAT) AS v
        FROM {name}_n)"""


def windows(size: int, overlap: int, name: str = "chunks") -> str:
    """CTE with fixed windows over all documents."""
    step = size - overlap
    return f"""
    {name} AS (SELECT doc_id, source, c AS chunk_index, c * {step} AS start,
        substr(text, c * {step} + 1, {size}) AS content
      FROM (SELECT doc_id, source, text,
              unnest(range(0, greatest(0, ceil((length(text) - {size}) / {step}.0))::INT + 1)) AS c
            FROM documents WHERE length(text) > 0))"""


def row_chunks(name: str, table: str, part: str, order: str, cols: str, size: int = 20, overlap: int = 3) -> str:
    """CTE with each row once per row group holding it."""
    step = size - overlap
    return f"""
    {name}_p AS (SELECT {part} AS part, {cols},
        row_number() OVER (PARTITION BY {part} ORDER BY {order}) - 1 AS r, count(*) OVER (PARTITION BY {part}) AS n
      FROM {table}),
    {name}_g AS (SELECT part, n, unnest(range(0, greatest(0, ceil((n - {size}) / {step}.0))::INT + 1)) AS c
      FROM (SELECT DISTINCT part, n FROM {name}_p)),
    {name} AS (SELECT p.*, g.c, g.c * {step} AS r0, least(g.c * {step} + {size}, g.n) AS r1
      FROM {name}_g g JOIN {name}_p p ON p.part = g.part AND p.r >= g.c * {step} AND p.r < g.c * {step} + {size})"""


def best_sentence(source: str, key: str) -> str:
    """CTEs ending in ``best(key, prediction)`` over ``source(key, question, context)``."""
    return f"""
    sent AS (SELECT {key}, question, unnest(l) AS sentence, generate_subscripts(l, 1) AS pos FROM (
        SELECT {key}, question, list_filter(list_transform(string_split(
            regexp_replace(context, '([.!?])\\s+|\\n+', '\\1' || chr(1), 'g'), chr(1)),
            lambda x: {strip('x')}), lambda x: x <> '') AS l FROM {source})),
    rated AS (SELECT {key}, sentence, pos,
        len(list_intersect(list_distinct({words('question')}), {words('sentence')})) AS hits FROM sent),
    best AS (SELECT a.{key}, coalesce(
        (SELECT arg_min(sentence, (-hits, pos)) FROM rated r WHERE r.{key} = a.{key} AND hits > 0),
        'I don''t have enough information in the provided documents.') AS prediction FROM {source} a)"""


def lcs(pairs: str, key: str) -> str:
    """Recursive CTEs ending in ``scored(key, rouge)`` over ``pairs(key, p, r)`` of token lists.

    One row of the dynamic programme per token of p.
    """
    return f"""
    dp AS (
      SELECT {key}, p, r, 0 AS i, list_transform(range(len(r) + 1), lambda j: 0) AS row FROM {pairs}
      UNION ALL
      SELECT {key}, p, r, i + 1, list_reduce(list_transform(range(len(r)), lambda j: [
            CASE WHEN p[i + 1] = r[j + 1] THEN row[j + 1] + 1 ELSE row[j + 2] END]),
          lambda acc, c: list_append(acc, greatest(acc[len(acc)], c[1])), [0]) AS row
      FROM dp WHERE i < len(p)),
    scored AS (SELECT {key}, round(CASE WHEN lcs = 0 OR np = 0 OR nr = 0 THEN 0
        ELSE 2 * (lcs / np) * (lcs / nr) / (lcs / np + lcs / nr) END, 6) AS rouge
      FROM (SELECT {key}, len(p)::DOUBLE AS np, len(r)::DOUBLE AS nr, row[len(row)]::DOUBLE AS lcs FROM dp WHERE i = len(p)))"""


CENTROIDS = """
    cent AS (SELECT label AS query_id, list(m ORDER BY d) AS q FROM (
      SELECT label, d, avg(embedding[d]::DOUBLE) AS m FROM embeddings, range(1, 65) r(d) GROUP BY label, d)
      GROUP BY label)"""

HITS = CENTROIDS + f""",
    hits AS (SELECT h.query_id, h.vec_id, h.score, h.rank, d.text AS content, d.source, d.lang
      FROM (SELECT query_id, vec_id, score,
              row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank
            FROM (SELECT query_id, vec_id, {d2('embedding', 'q')} AS score FROM cent, embeddings)
            QUALIFY rank <= 10) h
      JOIN documents d ON d.doc_id = h.vec_id)"""

METADATA = """
    meta AS (SELECT doc_id AS row_id, text AS content,
        CASE WHEN lang = 'en' AND n_chars % 2 = 0 THEN 'c' || doc_id ELSE '' END AS chunk_uid,
        CASE WHEN lang = 'fr' THEN 'v' || doc_id END AS vector_id,
        CASE WHEN lang = 'de' AND n_chars % 3 = 0 THEN 'i' || doc_id END AS id,
        CASE WHEN n_chars % 5 <> 0 THEN doc_id::VARCHAR ELSE '' END AS doc_id,
        CASE WHEN lang = 'es' THEN 'table_' || (n_chars % 7) END AS table_id,
        CASE WHEN lang = 'de' THEN '' END AS figure_id,
        CASE WHEN lang = 'en' THEN source || '.docx' END AS source_docx,
        CASE WHEN lang = 'es' THEN source || '.csv' ELSE '' END AS source_csv,
        CASE WHEN n_chars % 2 = 1 THEN source || '.png' END AS source_image
      FROM documents)"""

TABLE_CHUNKS = row_chunks("tc", "part", "p_type", "p_partkey", "p_partkey, p_name, p_brand, p_size") + """,
    tbody AS (SELECT part, c, r0, r1, n,
        string_agg('| ' || p_partkey || ' | ' || p_name || ' | ' || p_brand || ' | ' || p_size || ' |',
                   chr(10) ORDER BY r) AS body FROM tc GROUP BY part, c, r0, r1, n),
    tdocs AS (SELECT part AS table_id, c, r0, r1, n,
        'TABLE CHUNK' || chr(10) || 'doc_id: part' || chr(10) || 'table_id: ' || part || chr(10)
        || 'rows: ' || r0 || '..' || (r1 - 1) || ' (total_rows=' || n || ')' || chr(10)
        || 'columns: p_partkey, p_name, p_brand, p_size' || chr(10) || '---' || chr(10)
        || '| p_partkey | p_name | p_brand | p_size |' || chr(10) || '| --- | --- | --- | --- |' || chr(10)
        || body AS content
      FROM tbody)"""

FIGURES = """
    figs AS (SELECT page_id, 'figure_' || page_id AS figure_id, url AS source_image,
        to_json({type: 'screenshot', summary: regexp_extract(html, '<title>([^<]*)</title>', 1)})::VARCHAR AS content
      FROM pages)"""

COLLECTION = windows(500, 50, "tchunks") + "," + TABLE_CHUNKS + "," + FIGURES + f""",
    coll AS (
      SELECT {sid('doc_id', 'source', 'chunk_index', 'content')} AS chunk_id, 'text' AS modality, 1 AS mrank, content,
             doc_id::VARCHAR AS doc_id, source AS src FROM tchunks
      UNION ALL
      SELECT {sid("'part'", 'table_id', 'r0', 'r1', "'markdown'")}, 'table', 2, content, 'part', 'N/A' FROM tdocs
      UNION ALL
      SELECT {sid('page_id', 'figure_id', "'v1'")}, 'image_vlm', 3, content, page_id::VARCHAR, source_image FROM figs)"""

ENSEMBLE = COLLECTION + "," + vectors("cv", "coll", "chunk_id, modality, mrank", "content") + "," + vectors(
    "qv", "benchmark", "item_id", "text") + f""",
    scored AS (SELECT item_id AS query_id, chunk_id, modality, mrank, {d2('cv.v', 'qv.v')} AS score FROM qv, cv),
    perm AS (SELECT *, row_number() OVER (PARTITION BY query_id, modality ORDER BY score, chunk_id) AS rank
      FROM scored QUALIFY rank <= 4),
    ens AS (SELECT query_id, chunk_id, modality, score,
        row_number() OVER (PARTITION BY query_id ORDER BY score, mrank, rank) AS ensemble_rank
      FROM perm QUALIFY ensemble_rank <= 7),
    ehits AS (SELECT e.*, c.content, c.doc_id, c.src, b.text AS question,
        row_number() OVER (PARTITION BY e.query_id, e.chunk_id ORDER BY ensemble_rank) > 1 AS repeat
      FROM ens e JOIN coll c USING (chunk_id) JOIN benchmark b ON b.item_id = e.query_id),
    reranked AS (SELECT *, {overlap('question', 'content')} AS rerank_score,
        row_number() OVER (PARTITION BY query_id ORDER BY {overlap('question', 'content')} DESC, ensemble_rank) AS final_rank
      FROM ehits WHERE NOT repeat)"""


def recursive_chunks(size: int, overlap: int) -> str:
    """CTEs down to ``rchunks(doc_id, chunk_index, start, content)``: recursive splitting on offsets.

    Each level cuts the spans that hold its separator. Pieces below the size wait in runs between the
    larger ones, which go down a level; what is left at the end is cut into windows. A run is packed
    greedily: a window takes pieces while they fit, the next one starts at the first piece that keeps the overlap.
    """
    out, runs = " span0 AS (SELECT doc_id, text, 0 AS lo, length(text) AS hi FROM documents),", []
    for k, (sep, n) in enumerate((("chr(10) || chr(10)", 2), ("chr(10)", 1), ("'. '", 2), ("' '", 1))):
        body = "substr(text, (lo + 1)::BIGINT, (hi - lo)::BIGINT)"
        out += f"""
    cut{k} AS (SELECT doc_id, text, lo AS top, string_split({body}, {sep}) AS parts FROM span{k} WHERE contains({body}, {sep})),
    part{k} AS (SELECT doc_id, text, top, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM cut{k}),
    upto{k} AS (SELECT *, top + sum(length(part) + {n}) OVER (PARTITION BY doc_id, top ORDER BY i) - {n} AS hi FROM part{k}),
    piece{k} AS (SELECT *, CASE WHEN i = 1 THEN top ELSE hi - length(part) - {n} END AS lo FROM upto{k}),
    sized{k} AS (SELECT *, hi - lo >= {size} AS big,
        sum((hi - lo >= {size})::INT) OVER (PARTITION BY doc_id, top ORDER BY i) AS run FROM piece{k} WHERE hi > lo),
    span{k + 1} AS (SELECT doc_id, text, lo, hi FROM span{k} WHERE NOT contains({body}, {sep})
        UNION ALL SELECT doc_id, text, lo, hi FROM sized{k} WHERE big),"""
        runs.append(f"SELECT doc_id, {k} AS level, top, run, lo, hi FROM sized{k} WHERE NOT big")
    return out + f"""
    packs AS (SELECT doc_id, level, top, run, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his, count(*)::BIGINT AS n
        FROM ({' UNION ALL '.join(runs)}) GROUP BY ALL),
    wins AS (
        SELECT doc_id, level, top, run, 1::BIGINT AS f, list_max(list_filter(range(1, least(n, {size} + 1) + 1), lambda j: his[j] - los[1] <= {size})) AS l FROM packs
        UNION ALL
        SELECT doc_id, level, top, run, g AS f, list_max(list_filter(range(g, least(n, g + {size}) + 1), lambda j: his[j] - los[g] <= {size})) AS l
        FROM (SELECT p.*, list_min(list_filter(range(w.f + 1, w.l + 2), lambda x: x = w.l + 1
                OR (p.his[w.l] - p.los[x] <= {overlap} AND p.his[w.l + 1] - p.los[x] <= {size}))) AS g
            FROM wins w JOIN packs p USING (doc_id, level, top, run) WHERE w.l < p.n)),
    slides AS (SELECT doc_id, lo, hi, unnest(range(0, 1 + greatest(0, ceil((hi - lo - {size}) / {size - overlap}.0))::BIGINT)) AS i FROM span4 WHERE hi > lo),
    raws AS (
        SELECT doc_id, los[f] AS lo, his[l] AS hi FROM wins JOIN packs USING (doc_id, level, top, run)
        UNION ALL SELECT doc_id, lo + i * {size - overlap}, least(hi, lo + i * {size - overlap} + {size}) FROM slides),
    cuts AS (SELECT doc_id, lo, substr(text, (lo + 1)::BIGINT, (hi - lo)::BIGINT) AS raw FROM raws JOIN documents USING (doc_id)),
    rchunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY lo) - 1 AS chunk_index,
        lo + length(raw) - length(regexp_replace(raw, '^\\s+', '')) AS start, {strip('raw')} AS content
      FROM cuts WHERE {strip('raw')} <> '')"""
