"""The operators as queries on the test tables, with SQL where SQL can say the same."""

import string

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    chat_windows, decontaminate, hmm, host_rules, infilling, line_runs, packing, prefix_trie, pseudonyms,
    quality, sharding, simhash, urls,
)
from .text import remainder

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_jump_sharding")
def op1(spark, folder):
    """All documents over 8 shards by id; sizes in bytes, slots within the shard."""
    whole = F.coalesce("text", F.lit(""))
    documents = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.shard_rows(documents, "doc_id", 8, "shard", "grown_shard")
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return sharding.number_slots(placed).select(
        *[F.col(c).cast("long") if c == "slot" else c for c in columns]
    )


def packed_pieces(documents):
    """Pieces with a checksum of their ids, by the production parameters."""
    packed = packing.pack(
        documents,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "window",
        "step_group",
    )


@query("op2_hierarchical_packing")
def op2(spark, folder):
    """All documents as pieces of full windows of 128 to 1,024 tokens."""
    return packed_pieces(table(spark, folder, "documents"))


SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = f"translate({{0}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


@query(
    "op8_line_runs",
    f"""
    WITH split AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    placed AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
    keyed AS (SELECT *, {LOWER_SQL.format(f'trim(line, {SPACES_SQL})')} AS key FROM placed),
    common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE common.key IS NOT NULL) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                           FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN common ON keyed.key = common.key GROUP BY r, doc_id""",
)
def op8(spark, folder):
    """All documents without the lines that ten or more of them share."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return line_runs.dedup_lines(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op9_covering_simhash")
def op9(spark, folder):
    """All documents with their SimHash and the group it is linked to within 4 bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


QUALITY_THRESHOLD = 0.3


@query("op3_attention_quality")
def op3(spark, folder):
    """Quality of all documents, learned outside the held-out fifth."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score_documents(documents, table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= QUALITY_THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query("op7_hidden_markov_scores")
def op7(spark, folder):
    """Probability of all documents under a model learned from six sevenths of them."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return hmm.score_texts(documents, remainder("doc_id", 7) == 2)


HOST_RULES = ["short", "repetitive", "symbols", "dup_lines", "word_length"]
WORDS_SQL = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


@query(
    "op6_host_rules",
    rf"""
    WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, {WORDS_SQL} AS w FROM docs),
    windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
                                     FROM windows) WHERE n > 1),
    repeats AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
                FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
    lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)),
                                         lambda x: len(trim(x, {SPACES_SQL})) > 0) AS l FROM docs),
    m AS (
      SELECT doc_id, source, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines
      FROM docs JOIN w USING (doc_id) JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    checked AS (
      SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repetitive,
             10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS dup_lines,
             word_chars < 2 * n_words OR word_chars > 12 * n_words AS word_length FROM m),
    hosts AS (SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE failed) AS f
              FROM (UNPIVOT checked ON {', '.join(HOST_RULES)} INTO NAME rule VALUE failed)
              GROUP BY source, rule),
    moments AS (SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS q, count(*) / sum(n) AS h
                FROM hosts GROUP BY rule),
    priors AS (SELECT rule, m, least(greatest(m * (1 - m) / greatest(q - m * m - m * (1 - m) * h, 1e-12) - 1, 1), 1e6) AS k
               FROM moments),
    verdicts AS (SELECT source, max((f + m * k) / (n + k)) > 0.5 AS blocked
                 FROM hosts JOIN priors USING (rule) GROUP BY source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
           short OR repetitive AS base_failed, NOT (short OR repetitive) AND NOT blocked AS kept
    FROM checked JOIN verdicts ON checked.source IS NOT DISTINCT FROM verdicts.source""",
)
def op6(spark, folder):
    """All documents measured, and judged with their hosts."""
    return host_rules.judge(table(spark, folder, "documents"))


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query("op5_boosted_urls")
def op5(spark, folder):
    """All page URLs by the listed rules, or by trees learned from labelled URLs.

    A page is labelled if the document whose number is in its path is: unwanted are documents of
    low quality and toxic ones.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    number = F.expr(r"try_cast(regexp_extract(url, '/([0-9]+)(?:[^0-9].*)?$', 1) AS bigint)")
    elsewhere = -1 - F.pmod(F.xxhash64("url"), F.lit(1 << 40))  # spreads pages without a number
    labels = table(spark, folder, "labels").groupBy(F.col("doc_id").alias("number")).agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("label")
    )
    numbered = pages.withColumn("number", F.coalesce(number, elsewhere))
    return urls.judge(numbered.join(labels, "number", "left"), URL_RULES)


@query("op10_seeded_alignment")
def op10(spark, folder):
    """All documents that hold a benchmark item, whole or edited."""
    documents = table(spark, folder, "documents")
    return decontaminate.contaminated(documents, table(spark, folder, "benchmark"))


#: Only for the test tables; production passes a key of its own.
TEST_KEY = b"key for the test tables"


@query("op4_feistel_pseudonyms")
def op4(spark, folder):
    """All documents with pseudonyms for personal data, and where they stand."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(documents, TEST_KEY).select(
        "doc_id", "text", F.size("found").alias("n_found"), "found"
    )


UNITS_SQL = r"regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"


@query(
    "op13_counted_infilling",
    rf"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text,
                         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    drawn AS (SELECT doc_id, text, {UNITS_SQL} AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                     ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM docs),
    cuts AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
                    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                              OR h3 % 100 >= 50 THEN 'plain'
                         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    cut AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
                   array_to_string(u[b + 1:], '') AS s FROM cuts)
    SELECT doc_id, len(u) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM cut""",
)
def op13(spark, folder):
    """All documents, half of them rearranged for filling in the middle."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    moved = infilling.transform(documents)
    found = infilling.parts(F.col("output"), F.col("form"))
    return moved.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        F.length(found["prefix"]).cast("long").alias("prefix_chars"),
        F.length(found["middle"]).cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: CRC32 of the text of a number, bit by bit.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''),
        lambda x: ascii(x)::BIGINT)), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda a, i: xor(a >> 1, 3988292384::BIGINT * (a & 1)))), 4294967295::BIGINT)"""


@query(
    "op11_conversation_trie",
    f"""
    WITH said AS (SELECT conv_id AS c, turn, length(coalesce(text, '')) AS l,
                         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
                  FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m) AS i FROM said),
    ids AS (SELECT c, {CRC32_SQL.format('c')} % 6 AS h, c - c % 100 AS base FROM (SELECT DISTINCT c FROM said)),
    heads AS (SELECT ids.c, t.i AS d, m, l FROM ids JOIN t ON t.c = base AND t.i <= h),
    taken AS (SELECT c, count(*) AS k FROM heads GROUP BY c),
    rebuilt AS (SELECT * FROM heads UNION ALL
                SELECT ids.c, coalesce(k, 0) + t.i - h, m, l
                FROM ids JOIN t ON t.c = ids.c AND t.i > h LEFT JOIN taken ON taken.c = ids.c),
    named AS (SELECT c, d, l, md5(array_to_string(list(m) OVER (PARTITION BY c ORDER BY d), ',')) AS node FROM rebuilt),
    paths AS (SELECT c, d, l, node, lag(node, 1, 'root') OVER (PARTITION BY c ORDER BY d) AS parent FROM named
              UNION ALL SELECT c, 0, 0, 'root', NULL FROM ids),
    nodes AS (SELECT node, d, min(c) AS c, count(*) AS n, any_value(l) AS l, any_value(parent) AS parent
              FROM paths GROUP BY node, d),
    kids AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
    below AS (SELECT p.node, sum((nodes.n - 1) * nodes.l) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
              FROM nodes LEFT JOIN kids ON kids.parent = nodes.node
              JOIN paths p ON p.c = nodes.c AND p.d <= nodes.d GROUP BY p.node),
    ends AS (SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
             FROM (SELECT c, arg_max(node, d) AS node FROM paths GROUP BY c) GROUP BY node)
    SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.n AS n_convs,
           coalesce(kids.n, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
           sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes JOIN below USING (node) LEFT JOIN kids ON kids.parent = nodes.node
    LEFT JOIN ends ON ends.node = nodes.node LEFT JOIN nodes up ON up.node = nodes.parent""",
)
def op11(spark, folder):
    """All conversations, with shared heads, as a trie of their turns."""
    lists = prefix_trie.turn_lists(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.share_heads(lists))


ESCAPED_SQL = r"regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"


@query(
    "op12_budgeted_chat",  # the SQL holds for conversations within a block of 65,536 tokens
    rf"""
    WITH RECURSIVE said AS (
      SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    t AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
                 len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tok,
                 length({ESCAPED_SQL.format('role')}) + length({ESCAPED_SQL.format('text')}) + 20 AS chars FROM said),
    p AS (SELECT *, sum(tok) OVER (PARTITION BY c ORDER BY i) - tok AS pos,
                 sum(chars) OVER (PARTITION BY c ORDER BY i) AS done, count(*) OVER (PARTITION BY c) AS n,
                 max(CASE WHEN i = 0 AND role = 'system' THEN tok ELSE 0 END) OVER (PARTITION BY c) AS s,
                 max(CASE WHEN i = 0 AND role = 'system' THEN chars ELSE 0 END) OVER (PARTITION BY c) AS head,
                 max(CASE WHEN i = 0 AND role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY c) AS least FROM t),
    back AS (SELECT *, lag(pos, 1) OVER w AS pos1, lag(pos, 2) OVER w AS pos2,
                    lag(done, 1, 0) OVER w AS done1, lag(done, 2, 0) OVER w AS done2, lag(done, 3, 0) OVER w AS done3
             FROM p WINDOW w AS (PARTITION BY c ORDER BY i)),
    leads AS (SELECT *, CASE WHEN i - 2 >= least AND s + pos - pos2 + tok <= 1024 THEN 2
                             WHEN i - 1 >= least AND s + pos - pos1 + tok <= 1024 THEN 1 ELSE 0 END AS k FROM back),
    begun AS (SELECT *, CASE WHEN i = 0 THEN 0 ELSE s + CASE k WHEN 2 THEN pos - pos2 WHEN 1 THEN pos - pos1 ELSE 0 END END AS lead,
                     CASE k WHEN 2 THEN done3 WHEN 1 THEN done2 ELSE done1 END AS before FROM leads),
    ends AS (SELECT b.c, b.i, any_value(b.n) AS n, coalesce(min(f.i), any_value(b.n)) AS e,
                    any_value(CASE WHEN b.i > 0 THEN b.head ELSE 0 END - b.before) AS extra
             FROM begun b LEFT JOIN p f ON f.c = b.c AND f.i > b.i AND b.lead + f.pos + f.tok - b.pos > 1024
             GROUP BY b.c, b.i),
    w AS (SELECT c, i, e, n, extra FROM ends WHERE i = 0
          UNION ALL SELECT ends.c, ends.i, ends.e, ends.n, ends.extra FROM w JOIN ends ON ends.c = w.c AND ends.i = w.e
          WHERE w.e < w.n),
    sizes AS (SELECT w.c, sum(extra + p.done) AS chars, count(*) AS n FROM w JOIN p ON p.c = w.c AND p.i = w.e - 1 GROUP BY w.c)
    SELECT t.c AS conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           any_value(sizes.chars)::BIGINT AS formatted_chars, any_value(sizes.n) AS n_windows
    FROM t JOIN sizes USING (c) GROUP BY t.c""",
)
def op12(spark, folder):
    """All conversations, and one that says control strings, formatted and read back."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    written = chat_windows.windows(conversations.unionByName(more))
    turns = chat_windows.read_turns(F.col("text"), F.col("n_repeated"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = written.select(
        "conv_id",
        "block",
        "window",
        F.length("text").alias("chars"),
        (F.col("n_turns") - F.col("n_repeated")).alias("n_turns"),
        F.array_join(lines, "").alias("turns"),
        F.array_join(chat_windows.read_targets(F.col("text"), F.col("spans")), "").alias("loss"),
    )
    part = F.struct("block", "window", "turns", "loss")
    parts = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"),
        F.sort_array(F.collect_list(part)).alias("parts"),
    )

    def joined(name):
        return F.array_join(F.transform("parts", lambda p: p[name]), "")

    return parts.select(
        "conv_id",
        "n_turns",
        F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
