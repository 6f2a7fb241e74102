"""The queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dvspark.llm import bpa_search, bpe, kmeans_tree, langid, line_crf, mixing, neardup, ngram_lm, prefix_counts, quotes, son_phrases, templates, warc
from dvspark.llm.common import ORACLE, QUERIES, fold, query, table

__all__ = ["ORACLE", "QUERIES"]


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge-replay BPE ids of every text, and their bytes again."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False)


@query
def op3_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every text, and where its first 2,048 tokens end, from its prefix counts."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as spec:
        return prefix_counts.prefix_counts(table(spark, sf_dir, "documents"), spec.read(), budget=2048, keep_changes=False)


@query
def op7_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 5-word-shingle similarity 0.85 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney log10 probability of every text, learned from the texts outside fold 2 of 7."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    return ngram_lm.score(docs, ngram_lm.train(docs.where(~held_out)), held_out)


@query
def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLE["op9_warc_dictionary"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex FROM p
), bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', substr(hex, i::INT, 1))]), '') AS b
  FROM d
), digests AS (
  SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 32), lambda k: substr('{_BASE32}', (1 + 16 * substr(b, (5*k+1)::INT, 1)::INT + 8 * substr(b, (5*k+2)::INT, 1)::INT + 4 * substr(b, (5*k+3)::INT, 1)::INT + 2 * substr(b, (5*k+4)::INT, 1)::INT + substr(b, (5*k+5)::INT, 1)::INT)::INT, 1)), '') AS payload_digest
  FROM bits
), latest AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS m FROM digests
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < m THEN m END AS refers_to
FROM latest
"""


@query
def op2_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its lines' marginals, learned from the labels outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = line_crf.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = line_crf.score(docs.select("text", "doc_id", held_out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= line_crf.CUT).cast("int").alias("predicted"))


@query
def op4_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by its spans, learned from the texts outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = langid.train(docs, ~held_out)
    found = langid.predict(docs.select("text", "doc_id", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_spans").alias("n_spans"))


@query
def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every vec_id divisible by 100."""
    return kmeans_tree.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share template windows with benchmark items, and which of them the items contaminate."""
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, behind the message that it answers."""
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


#: Messages of one turn can't be told apart in order here, as their names are hashes; conversations have one a turn.
ORACLE["op6_quote_links"] = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, count(*) AS copies, row_number() OVER (ORDER BY conv_id, turn, role, text) AS id
  FROM conversations GROUP BY conv_id, turn, role, text
), quoting AS (
  SELECT * FROM m WHERE regexp_matches(coalesce(text, ''), '(^|\n)[ \t]*>')
), split AS (
  SELECT id, regexp_split_to_array(text, '\r?\n') AS rows FROM quoting
), numbered AS (
  SELECT id, unnest(range(1, len(rows) + 1)) AS pos, unnest(rows) AS line FROM split
), marked AS (
  SELECT id, pos, line, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level, regexp_replace(line, '^(?:[ \t]*>)+', '') AS words FROM numbered
), near AS (
  SELECT *, lag(level) OVER w AS before, lead(level) OVER w AS behind FROM marked WINDOW w AS (PARTITION BY id ORDER BY pos)
), grouped AS (
  SELECT *, sum(CASE WHEN before IS DISTINCT FROM level THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS passage,
         level = 0 AND coalesce(behind, 0) > 0 AND regexp_matches(line, '^[ \t]*On .{1,200} wrote:[ \t]*$') AS attribution
  FROM near
), own AS (
  SELECT id, trim(string_agg(line, chr(10) ORDER BY pos), ' ' || chr(9) || chr(13) || chr(10)) AS body FROM grouped WHERE level = 0 AND NOT attribution GROUP BY id
), bodies AS (
  SELECT m.id, CASE WHEN quoting.id IS NULL THEN coalesce(m.text, '') ELSE coalesce(own.body, '') END AS body
  FROM m LEFT JOIN quoting USING (id) LEFT JOIN own USING (id)
), passages AS (
  SELECT id, passage, any_value(level) AS level, list(words ORDER BY pos) AS rows FROM grouped WHERE level > 0 GROUP BY id, passage
), units AS (
  SELECT id, passage, level, lower(trim(regexp_replace(u, '\s+', ' ', 'g'))) AS unit
  FROM (SELECT id, passage, level, unnest(list_append(rows, array_to_string(rows, ' '))) AS u FROM passages)
), parts AS (
  SELECT id, unnest([body] || regexp_split_to_array(body, '\n\s*\n') || string_split(body, chr(10))) AS u FROM bodies WHERE body <> ''
), held AS (
  SELECT DISTINCT id, conv_id, turn, lower(trim(regexp_replace(u, '\s+', ' ', 'g'))) AS unit
  FROM parts JOIN m USING (id) WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), in_conv AS (
  SELECT unit, conv_id, min({'turn': turn, 'id': id}) AS o FROM held WHERE length(unit) >= 12 GROUP BY unit, conv_id
), overall AS (
  SELECT unit, min({'conv_id': conv_id, 'turn': o.turn, 'id': o.id}) AS o FROM in_conv GROUP BY unit
), found AS (
  SELECT a.id, a.level, length(a.unit) AS size,
         CASE WHEN i.o.turn < m.turn THEN {'conv_id': m.conv_id, 'turn': i.o.turn, 'id': i.o.id} WHEN v.o.conv_id < m.conv_id THEN v.o END AS original
  FROM (SELECT DISTINCT id, level, unit FROM units WHERE length(unit) >= 12) a JOIN m USING (id)
  LEFT JOIN in_conv i ON i.unit = a.unit AND i.conv_id = m.conv_id LEFT JOIN overall v ON v.unit = a.unit
  WHERE m.conv_id IS NOT NULL AND m.turn IS NOT NULL
), linked AS (
  SELECT id, arg_min(original.id, (level, -size, original)) AS quoted, count(*) AS linked FROM found WHERE original IS NOT NULL GROUP BY id
), earlier AS (
  SELECT a.id, arg_max(b.id, b.turn) AS earlier FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.turn < a.turn GROUP BY a.id
), parents AS (
  SELECT m.id, coalesce(quoted, earlier) AS parent FROM m LEFT JOIN linked USING (id) LEFT JOIN earlier USING (id)
), up AS (
  SELECT id, id AS top, 0 AS depth FROM m
  UNION ALL
  SELECT up.id, p.parent, depth + 1 FROM up JOIN parents p ON p.id = up.top WHERE p.parent IS NOT NULL
), roots AS (
  SELECT id, arg_max(top, depth) AS root, max(depth) AS depth FROM up GROUP BY id
), quotes AS (SELECT id, count(*) AS n_quotes FROM passages GROUP BY id)
SELECT m.conv_id, m.turn, m.role, m.copies, r.conv_id AS thread_conv, r.turn AS thread_turn, CAST(roots.depth AS BIGINT) AS depth,
       q.conv_id AS reply_conv, q.turn AS reply_turn, coalesce(n_quotes, 0) AS n_quotes, coalesce(linked, 0) AS linked_quotes,
       concat_ws(': ', m.role, body) AS chat
FROM m JOIN bodies USING (id) JOIN roots USING (id) JOIN m r ON r.id = roots.root JOIN parents USING (id)
LEFT JOIN m q ON q.id = parents.parent LEFT JOIN quotes ON quotes.id = m.id LEFT JOIN linked ON linked.id = m.id
"""


ORACLE["op7_minhash_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), sides AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM w
  UNION
  SELECT reach.doc_id, y FROM reach JOIN sides ON x = r
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query
def op11_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources to weights 1, 2, 3, ... takes of every document."""
    return mixing.words_taken(mixing.mix(table(spark, sf_dir, "documents"))).drop("source", "src")


#: A source's slots take the first ``goal`` words of its stream, over and over: what each document's share of them is.
ORACLE["op11_golden_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(md5(text), 'null') AS digest, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::HUGEINT AS weight FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER w AS nth, sum(source_size) OVER () - (sum(3 * source_size) OVER w - 3 * source_size) AS remaining, sum(weight) OVER () - (sum(weight) OVER w - weight) AS share
  FROM s WINDOW w AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT arg_min(remaining, nth)::HUGEINT AS remaining, arg_min(share, nth)::HUGEINT AS share FROM o WHERE 3 * source_size * share >= weight * remaining
), t AS (
  SELECT source, source_size, weight * level.remaining > 3 * source_size * level.share AS above, weight * level.remaining AS wanted, level.share FROM s, level
), g AS (
  SELECT source, source_size, CASE WHEN above THEN 3.0 * source_size::DOUBLE ELSE wanted::DOUBLE / share::DOUBLE END AS target, CASE WHEN above THEN 3 * source_size ELSE wanted // share END AS goal FROM t
), h AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || digest), 1, 15))::BIGINT AS place FROM d
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING) - size AS start FROM h
)
SELECT doc_id, size, g.source_size::BIGINT AS source_size, target,
       coalesce((goal // g.source_size) * size + least(greatest(goal % g.source_size - start, 0), size), 0)::BIGINT AS taken
FROM placed JOIN g ON g.source IS NOT DISTINCT FROM placed.source
"""


@query
def op12_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 documents that score highest for each benchmark item."""
    return bpa_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op12_best_position_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS ts FROM documents
), sizes AS (
  SELECT row, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0
), overall AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), tf AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(ts) AS term FROM d) GROUP BY row, term
), df AS (
  SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM df, overall
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), scores AS (
  SELECT item_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (row), overall GROUP BY item_id, row
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM scores JOIN sizes USING (row) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query
def op13_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of 2 to 3 words of every language."""
    return son_phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_son_collocations"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces WHERE len(ws) > 0
), grams AS (
  SELECT lang, [ws[i]] AS p FROM starts
  UNION ALL SELECT lang, ws[i : i + 1] FROM starts WHERE i + 1 <= len(ws)
  UNION ALL SELECT lang, ws[i : i + 2] FROM starts WHERE i + 2 <= len(ws)
), totals AS (
  SELECT lang, count(*)::BIGINT AS n FROM starts GROUP BY lang
), f AS (
  SELECT lang, p, count(*)::HUGEINT AS f FROM grams GROUP BY lang, p HAVING count(*) >= 10
), cuts AS (
  SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1
), scores AS (
  SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f * r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = c.p[1 : c.k] JOIN f r ON r.lang = c.lang AND r.p = c.p[c.k + 1 : len(c.p)]
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, q, max(f) AS f FROM (SELECT lang, p[1 : 2] AS q, f FROM f WHERE len(p) = 3 UNION ALL SELECT lang, p[2 : 3], f FROM f WHERE len(p) = 3) GROUP BY lang, q
), kept AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, s.a, s.l, s.r, s.score FROM lowest s LEFT JOIN inner_ i ON i.lang = s.lang AND i.q = s.p
  WHERE i.f IS NULL OR 100 * i.f < 50 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
