"""The registered queries of the training-data operators: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm import bpe, chat, counts, language, packing, phrases, quality, repeats, search, simhash, spelling, warc, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def oracle(sql: str):
    """Also register the SQL of the query's rows."""
    def register(fn):
        ORACLES[fn.__name__] = sql.strip()
        return query(fn)

    return register


#: The letters that SQL's translate() lowers.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@oracle(r"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM numbered),
passages AS (SELECT r, i, words[i] AS word,
  CASE WHEN i + 34 <= len(words) THEN array_to_string(words[i:i + 34], ' ') END AS passage FROM placed),
again AS (SELECT passage FROM passages WHERE passage IS NOT NULL GROUP BY passage HAVING count(*) > 1),
marked AS (SELECT p.r, p.i, p.word, a.passage IS NOT NULL AS starts FROM passages p LEFT JOIN again a ON a.passage = p.passage),
judged AS (SELECT r, i, word, coalesce(max(CASE WHEN starts THEN i END) OVER (PARTITION BY r ORDER BY i) >= i - 34, false) AS gone FROM marked),
kept AS (SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
  string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM numbered LEFT JOIN kept k USING (r)""")
def op3_substring_dedup(spark, sf_dir):
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "repeats.n_words", "repeats.n_removed",
                        F.sha2("repeats.kept", 256).alias("kept_sha256"))


@query
def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = quality.judged(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                        "quality.n_repeat_words", "quality.base_failed", "quality.kept", "quality.rejected_by")


@query
def op7_language_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.filter(~language.held_out() & F.col("doc_id").isNotNull()))
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), F.col("language.pred").alias("lang_pred"),
                        "language.score", "language.parts")


@query
def op10_best_fit_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query
def op9_wavelet_tokens(spark, sf_dir):
    return wavelet.stored_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op2_forced_boundary_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return found.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


@query
def op6_chat_windows(spark, sf_dir):
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    found = chat.read_back(chat.windows(turns))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("targets", "")
    return found.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


@query
def op4_warc_fixity(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    # The second replica loses a bit in about one of a hundred records, chosen by their ids.
    damaged = F.crc32(F.col("page_id").cast("string").cast("binary")) % 101 == 0
    return warc.audited_replicas(pages, damaged)


@query
def op1_bm25_top_k(spark, sf_dir):
    return search.top_k(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query
def op13_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = counts.counted(docs, public_tokenizers.path("piece_bpe_32k.model"), columns=["doc_id"])
    return found.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


@oracle(rf"""
WITH plain AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM plain),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
sized AS (SELECT lang, words, i, unnest(range(1, least(5, len(words) - i + 1) + 1)) AS m FROM placed),
counted AS (SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, m, CAST(count(*) AS HUGEINT) AS f FROM sized
  GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
parts AS (SELECT c.lang, c.phrase, c.a, c.k, t.n, x.f AS l, y.f AS r, 1000 * c.a * t.n // (x.f * y.f) AS score FROM cuts c
  JOIN totals t ON t.lang = c.lang
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1:], ' ')),
lowest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, a, words, m, unnest(range(2, m)) AS s FROM candidates),
inside AS (SELECT lang, a, words, s, unnest(range(1, m - s + 2)) AS i FROM longer),
covered AS (SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, max(a) AS most FROM inside GROUP BY ALL),
ranked AS (SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(o.phrase)) AS rank
  FROM lowest o LEFT JOIN covered c ON c.lang = o.lang AND c.phrase = o.phrase WHERE c.most IS NULL OR 100 * c.most < 100 * o.a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""")
def op12_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, keep=2000, share=100)


@oracle(rf"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, repeat([0::BIGINT], 8)),
  lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
runs AS (SELECT CAST(doc_id AS VARCHAR) AS doc, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
lowered AS (SELECT coalesce(doc, '') AS doc, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS times FROM runs
  WHERE length(run) >= 7 GROUP BY ALL),
spelled AS (SELECT run, times, hex(encode(concat(doc, ':', run))) AS digits FROM lowered),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(
  list_prepend(4294967295, list_transform(range(0, length(digits) // 2), lambda i: CAST(concat('0x', digits[2 * i + 1:2 * i + 2]) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM spelled, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN concat(run[1:h % length(run)], run[h % length(run) + 2:]) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS (SELECT word, n, i, concat(word[1:i - 1], word[i + 1:]) AS rest FROM places),
pairs AS (SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.rest
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.rest),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, encode(other))) AS other, max(n) AS most FROM pairs GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN other END AS form,
  CASE WHEN most >= 10 * w.n THEN most END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (SELECT word, word AS root, form AS onward FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.onward)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.onward IS NULL""")
def op11_spelling_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return spelling.variants(spelling.document_words(docs, shortest=7, every=31), fewest=2, ratio=10)
