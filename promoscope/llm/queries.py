"""One query per operator over the whole driver tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoscope.llm import (
    chat_trees,
    containment,
    cuckoo_lines,
    dialog_repair,
    extendible,
    mix_threshold,
    repeat_intervals,
    rule_cascade,
    setsketch,
    spelling_variants,
    token_groups,
    toxicity_cnn,
    warc_captures,
)
from promoscope.llm._common import findable


def _table(spark, sf_dir, name):
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_trees(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    trees = chat_trees.as_trees(turns.unionByName(extra))
    return chat_trees.digests(chat_trees.format_trees(trees)).withColumnRenamed(
        "tree", "conv_id").drop("leaf")


def op2_shard_by_extendible_hash(spark, sf_dir):
    return extendible.shard(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_warc_captures(spark, sf_dir):
    return warc_captures.page_captures(_table(spark, sf_dir, "pages"))


def op4_toxicity_cnn(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model, cuts = toxicity_cnn.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity_cnn.score(docs, model, cuts).select(
        "doc_id", toxicity_cnn.held_out().alias("held_out"), "score", "predicted",
        F.col("toxic").alias("toxic_by_language"))


def op5_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return cuckoo_lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_near_dedup(spark, sf_dir):
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op7_quality_cascade(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    m = rule_cascade.with_metrics(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    out = rule_cascade.cascade(m, metrics={n: F.col(n) for n in names})
    failed = rule_cascade.base_failed({n: F.col(n) for n in names})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", failed.alias("base_failed"),
                      F.col("rejected_by").isNull().alias("kept"))


def op8_mix_sources(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_threshold.mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_decontaminate(spark, sf_dir):
    return containment.contained_items(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_shared", "n_item")


def op10_repeat_intervals(spark, sf_dir):
    return repeat_intervals.repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def damaged_turns(turns):
    """The rows of ``turns`` as the contract of operator 13 damages them."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    code = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    times = F.when(code == 0, 0).when(code == 3, 2).otherwise(1)
    return turns.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def op13_dialog_repair(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    done = dialog_repair.repair_digests(damaged_turns(turns)).withColumnRenamed("conv_id", "__conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return turns.select("conv_id").distinct().join(
        done, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op11_token_group_join(spark, sf_dir):
    return token_groups.jaccard_join(_table(spark, sf_dir, "documents"), shingle=3, threshold_pct=90)


def misspelt_words(docs):
    """One row (word) per letter run of ``docs``, some with a deletion, as
    the contract of operator 12 has them."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(
        spelling_variants.runs(F.col("text"))).alias("run"))
    run = run.where(F.char_length("run") >= spelling_variants.MIN_CHARS)
    code = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    run = run.select("run", code.alias("code"))
    at = (F.col("code") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return run.select(F.when(F.col("code") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants.variants(misspelt_words(docs))


_BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP7_METRICS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_WORDS.format('text')} AS w FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM ln
       WHERE trim(l, {_BLANK}) <> '' GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN lc USING (doc_id))
"""

_REJECTED = f"""100 * n_symbols > {rule_cascade.MAX_SYMBOL_PCT} * n_words
    OR (n_dup_lines >= {rule_cascade.MIN_DUP_LINES}
      AND 100 * n_dup_lines > {rule_cascade.MAX_DUP_LINE_PCT} * n_lines)
    OR (n_words >= {rule_cascade.MIN_MEAN_OVER}
      AND (word_chars < {rule_cascade.MIN_MEAN_WORD} * n_words
        OR word_chars > {rule_cascade.MAX_MEAN_WORD} * n_words))"""

OP7_SQL = OP7_METRICS + rf"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {rule_cascade.MIN_WORDS} OR 100 * n_repeat_words > {rule_cascade.MAX_REPEAT_PCT} * n_words) AS base_failed,
  NOT (n_words < {rule_cascade.MIN_WORDS} OR 100 * n_repeat_words > {rule_cascade.MAX_REPEAT_PCT} * n_words
    OR {_REJECTED}) AS kept
FROM m
"""

_HASH = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT"

OP8_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, {_HASH} AS h,
  len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size FROM documents),
src AS (SELECT source, s, b, [3.0, 1.0, 2.0][(rk % 3 + 1)::INT] AS w FROM (
  SELECT source, sum(size)::DOUBLE AS s, sum(sum(size)) OVER () * 1.5::DOUBLE AS b,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM d GROUP BY source)),
lv AS (SELECT *, row_number() OVER o AS pos,
    ((b - coalesce(sum(2 * s) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0))) AS lev
  FROM src WINDOW o AS (ORDER BY 2 * s / w, source NULLS LAST),
    p AS (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, s, least(2 * s, w * coalesce((SELECT lev FROM lv WHERE lev * w <= 2 * s ORDER BY pos LIMIT 1), 1e300))::DOUBLE AS target FROM lv),
r AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS whole FROM t),
g AS (SELECT source, h, sum(size) AS gs FROM d GROUP BY source, h),
c AS (SELECT g.source, h, gs, whole, target - whole * s AS need,
    sum(gs) OVER (PARTITION BY g.source ORDER BY h) AS cum FROM g JOIN r ON g.source IS NOT DISTINCT FROM r.source),
k AS (SELECT source, h, whole, (cum <= need OR (cum - gs <= need AND 2 * (need - (cum - gs)) >= gs)) AS more FROM c)
SELECT doc_id, size, s::BIGINT AS source_size, target,
  (size * (k.whole + CASE WHEN more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""

OP2_SQL = rf"""
WITH d AS (SELECT doc_id, {_HASH} AS h, coalesce(strlen(text), 0)::BIGINT AS n_bytes FROM documents),
p AS (SELECT doc_id, n_bytes, h, dep, h >> (60 - dep) AS pre FROM d, (SELECT unnest(generate_series(0, 60)) AS dep)),
s AS (SELECT dep, pre, sum(n_bytes) AS b, count(DISTINCT h) AS c FROM p GROUP BY dep, pre),
f AS (SELECT p.doc_id, p.n_bytes, p.h, min(p.dep) AS dep FROM p JOIN s USING (dep, pre)
  WHERE b <= {extendible.SHARD_BYTES} OR c = 1 GROUP BY p.doc_id, p.n_bytes, p.h)
SELECT doc_id, n_bytes, CASE WHEN f.dep = 0 THEN '' ELSE lpad(bin(h >> (60 - f.dep)), f.dep::INT, '0') END AS shard,
  f.dep::INTEGER AS shard_depth, b::BIGINT AS shard_bytes
FROM f JOIN s ON s.dep = f.dep AND s.pre = f.h >> (60 - f.dep)
"""

OP9_SQL = rf"""
WITH dw AS (SELECT doc_id, {_WORDS.format('lower(text)')} AS w FROM documents),
iw AS (SELECT item_id, w, least(len(w), 5) AS k FROM (
       SELECT item_id, {_WORDS.format('lower(text)')} AS w FROM benchmark) WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i+k-1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
             FROM dw, (SELECT DISTINCT k FROM iw))),
it AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i+k-1], ' ') AS g
       FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM iw)),
n AS (SELECT item_id, count(*) AS n_item FROM it GROUP BY item_id)
SELECT doc_id, item_id, count(*)::INTEGER AS n_shared, any_value(n_item)::INTEGER AS n_item
FROM ds JOIN it USING (k, g) JOIN n USING (item_id) GROUP BY doc_id, item_id
HAVING 100 * count(*) >= {containment.THRESHOLD_PCT} * any_value(n_item)
"""

OP1_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
a AS (SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(13 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '|', '&vert;'))
    + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT * FROM a
"""

OP3_SQL = rf"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc_captures.MIN_REVISIT} AND page_id <> first THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc_captures.MIN_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM f
"""

OP5_SQL = rf"""
WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= {cuckoo_lines.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, (r.key IS NOT NULL AND doc_id <> owner) AS gone FROM k LEFT JOIN r ON r.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

def near_sql(k: int, pct: int = 80) -> str:
    """Near-duplicate groups of ``documents`` on k-word shingles."""
    joined = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - {k - 1}), lambda i: {joined}) END) AS g
  FROM w WHERE len(w) > 0)),
c AS (SELECT doc_id, list_sort(list(g)) AS gs FROM s GROUP BY doc_id),
node AS (SELECT gs, min(doc_id) AS rep, len(gs) AS n FROM c GROUP BY gs),
ns AS (SELECT rep, unnest(gs) AS g, n FROM node),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM ns a JOIN ns b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= {pct} * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep),
e AS (SELECT a, b FROM p WHERE 100 * k >= {pct} * (na + nb - k)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(x, y) AS (SELECT rep, rep FROM node UNION SELECT reach.x, sym.b FROM reach JOIN sym ON reach.y = sym.a),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(node.n, 0)::BIGINT AS n_shingles,
  coalesce(comp.component_id, d.doc_id) AS component_id,
  coalesce(comp.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN node USING (gs) LEFT JOIN comp ON comp.x = node.rep
"""


OP6_SQL = near_sql(2)


def _crc32_sql(text: str, columns: str, source: str) -> str:
    """CTEs ending in ``crc``: ``columns`` of ``source`` with the CRC-32 c of ``text``."""
    last = "SELECT i::BIGINT AS i, i::BIGINT AS v FROM range(256) AS r(i)"
    for _ in range(8):
        last = f"SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM ({last})"
    return f"""tab AS (SELECT list(v ORDER BY i) AS t FROM ({last})),
hx AS (SELECT {columns}, hex(encode({text})) AS x FROM {source}),
crc AS (SELECT * EXCLUDE (x, t), xor(list_reduce(list_prepend(4294967295, list_transform(
    generate_series(1, len(x) - 1, 2), lambda p: ('0x' || substr(x, p, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS c FROM hx, tab)"""


def _repair_step() -> str:
    """Cheapest edits after one more row, per state; an entry is the cost
    in six digits and the edits, so the least string is the best."""
    def add(entry, cost, edit):
        return f"lpad((left({entry}, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({entry}, 7) || '{edit}'"

    keep, again = "CASE WHEN f = 3 THEN 5 ELSE 0 END", "CASE WHEN f = 3 THEN 6 ELSE 1 END"
    into = {"s0": [], "s1": [("s0", "s")], "s2": [("s0", "u"), ("s1", "u"), ("s3", "u")], "s3": [("s2", "a")]}
    out = []
    for state, froms in into.items():
        best = [add(state, 2, "D")]
        for source, who in froms:
            best.append(f"CASE WHEN f IN (0, 3) AND who = '{who}' THEN {add(source, keep, 'K')} END")
            if who != "s":
                best.append(f"CASE WHEN f IN (0, 3) THEN {add(source, again, 'R')} END")
        out.append(f"least({', '.join(best)}) AS {state}" if len(best) > 1 else f"{best[0]} AS {state}")
    return ", ".join(out)


def _repair_inserts(source: str) -> str:
    def add(entry):
        return f"lpad((left({entry}, 6)::INT + 5)::VARCHAR, 6, '0') || substr({entry}, 7) || 'I'"

    for _ in range(2):
        source = (f"SELECT * REPLACE (least(s2, {add('s0')}, {add('s1')}, {add('s3')}) AS s2, "
                  f"least(s3, {add('s2')}) AS s3) FROM ({source})")
    return source


OP11_SQL = f"SELECT doc_id, n_shingles, component_id FROM ({near_sql(3, 90)})"

OP12_SQL = rf"""
WITH RECURSIVE src AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS ck, run, count(*) AS times FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
{_crc32_sql("ck", "run, times", "src")},
v AS (SELECT word, sum(times)::BIGINT AS n FROM (SELECT times, CASE WHEN c % 97 = 0
    THEN left(run, (c % length(run))::INT) || substr(run, (c % length(run))::INT + 2) ELSE run END AS word FROM crc)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM v)),
near AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest
    AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN v ON cut.rest = v.word
  UNION SELECT v.word, cut.word FROM cut JOIN v ON cut.rest = v.word),
ranked AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near,
  row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k FROM near JOIN v ON v.word = b),
form AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN r.n >= 2 * v.n THEN b END AS form,
  CASE WHEN r.n >= 2 * v.n THEN r.n END AS form_n FROM v LEFT JOIN ranked r ON r.a = v.word AND k = 1),
walk AS (SELECT word, word AS here, form AS onward FROM form
  UNION ALL SELECT walk.word, form.word, form.form FROM walk JOIN form ON form.word = walk.onward)
SELECT form.word, n, n_near, form, form_n, here AS root FROM form JOIN walk ON walk.word = form.word AND onward IS NULL
"""

_FAR = "'900000'"

OP13_SQL = rf"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS ck FROM conversations),
{_crc32_sql("ck", "conv_id, turn, role, text", "src")},
dmg AS (SELECT conv_id, turn, CASE WHEN c % 20 = 4 THEN 'user' ELSE role END AS role,
  CASE c % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, (VALUES (1), (2)) AS t(k) WHERE c % 20 <> 0 AND (k = 1 OR c % 20 = 3)),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS j,
  trim(text, {_BLANK}) AS body FROM dmg),
flt AS (SELECT conv_id, turn, role, text, j, left(role, 1) AS who, CASE WHEN body = '' THEN 1
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY j) > 1 THEN 2
  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f FROM num),
adj AS (SELECT *, lag(who) OVER (PARTITION BY conv_id ORDER BY j) || who AS pair FROM flt),
cnt AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (f = 1)::BIGINT AS blank, count(*) FILTER (f = 2)::BIGINT AS duplicate,
  count(*) FILTER (f = 3)::BIGINT AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM adj GROUP BY conv_id),
dp AS ({_repair_inserts(f"SELECT conv_id, 0::BIGINT AS j, '000000' AS s0, {_FAR} AS s1, {_FAR} AS s2, {_FAR} AS s3 FROM cnt")}
  UNION ALL ({_repair_inserts(f"SELECT dp.conv_id, flt.j, {_repair_step()} FROM dp JOIN flt ON dp.conv_id IS NOT DISTINCT FROM flt.conv_id AND flt.j = dp.j + 1")})),
best AS (SELECT cnt.*, least(s0, s3) AS b FROM cnt JOIN dp ON cnt.conv_id IS NOT DISTINCT FROM dp.conv_id AND cnt.n = dp.j),
ed AS (SELECT conv_id, p, substr(b, 6 + p, 1) AS e FROM (
  SELECT conv_id, b, unnest(generate_series(1, len(b) - 6)) AS p FROM best)),
ej AS (SELECT conv_id, p, e, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS j FROM ed),
kept AS (SELECT ej.conv_id, p, e, CASE WHEN e = 'I' THEN '' ELSE text END AS text, role, who,
    count(*) FILTER (e <> 'K' OR who <> 's') OVER (PARTITION BY ej.conv_id ORDER BY p) AS place
  FROM ej LEFT JOIN flt ON ej.conv_id IS NOT DISTINCT FROM flt.conv_id AND ej.j = flt.j WHERE e <> 'D'),
fixed AS (SELECT conv_id, sha256(string_agg((CASE WHEN e = 'K' THEN role WHEN place % 2 = 1 THEN 'user'
  ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY p)) AS sha FROM kept GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(b, 6)::BIGINT, 0) AS cost,
  coalesce(substr(b, 7), '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
LEFT JOIN fixed ON o.conv_id IS NOT DISTINCT FROM fixed.conv_id
"""

QUERIES = {f.__name__: f for f in (
    op1_chat_trees, op2_shard_by_extendible_hash, op3_warc_captures, op4_toxicity_cnn, op5_line_dedup, op6_near_dedup, op7_quality_cascade, op8_mix_sources, op9_decontaminate,
    op10_repeat_intervals, op11_token_group_join, op12_spelling_variants, op13_dialog_repair)}

ORACLES = {
    "op1_chat_trees": OP1_SQL,
    "op3_warc_captures": OP3_SQL,
    "op6_near_dedup": OP6_SQL,
    "op5_line_dedup": OP5_SQL,
    "op2_shard_by_extendible_hash": OP2_SQL,
    "op7_quality_cascade": OP7_SQL,
    "op8_mix_sources": OP8_SQL,
    "op9_decontaminate": OP9_SQL,
    "op11_token_group_join": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "op13_dialog_repair": OP13_SQL,
}
