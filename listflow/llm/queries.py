"""The registered queries of this subpackage, ``opN_<name>``, and their DuckDB oracles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listflow.llm import (
    extraction, licences, line_rules, media, mixing, packing, prefix_trie, quality, quotations, similar, token_counts, toxicity,
    whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public vocabulary; ``.tiktoken`` holds the same ids as the ``.json`` of its name."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a GIF and read back."""
    stored = media.store_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return media.media_digest(stored).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of weighted sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from four of five label folds."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    forest = quality.fit_quality(docs, labels)
    return quality.score_quality(docs, forest).select(
        "doc_id", (quality.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from two of three label folds."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (quality.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chat message without quotes, with its place in the conversation's threads."""
    return quotations.thread_messages(table(spark, sf_dir, "conversations")).select(
        "conv_id", "turn", "role", "own_text", "n_quoted", "max_level", "n_linked", "reply_to", "thread_turn", "depth")


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rules and base statistics of every document."""
    return line_rules.line_first(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_failed_lines", "lost_words")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the pieces of every document stand in sequences of 2048 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary())
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return similar.join_similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_shingles")


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return licences.scan_licences(table(spark, sf_dir, "documents")).withColumn(
        "licences", F.array_join("licences", ",")).withColumn("dice", F.round("dice", 9))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), keep=["doc_id"])


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the four strongest components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_media_columns, op3_source_mix, op4_quality_classifier, op5_toxicity,
    op6_quotation_threads, op7_line_rules, op8_packing, op9_ngram_jaccard_join, op10_licence_scan,
    op11_token_counts, op12_conversation_trie, op13_embedding_whitening, pipeline)}

_OP3 = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 12))::bigint as place
  from documents),
sources as (
  select source, sum(size)::bigint as s,
         [5, 2, 1][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::bigint as w
  from docs group by source),
lined as (
  select *, sum(2 * s) over before as full_before, sum(w) over () - sum(w) over before as open_left, sum(s) over () as total,
         row_number() over (order by 2.0 * s / w, source) as k
  from sources window before as (order by 2.0 * s / w, source rows between unbounded preceding and 1 preceding)),
levels as (
  select k, 3 * total - 2 * coalesce(full_before, 0) as level, 2 * coalesce(open_left, (select sum(w) from sources)) as parts, s, w from lined),
cut as (select level, parts from levels where level::hugeint * w <= 2::hugeint * s * parts order by k limit 1),
targets as (
  select source, s, case when cut.level is null or 2::hugeint * s * cut.parts < cut.level::hugeint * w then (2 * s)::double
              else (w * cut.level)::double / cut.parts::double end as target
  from sources left join cut on true),
summed as (
  select d.*, s, target, case when target >= s then s else 0 end as whole,
         sum(size) over (partition by d.source order by place) as upto,
         sum(size) over (partition by d.source, place) as tied
  from docs d join targets t on d.source is not distinct from t.source),
left_over as (select *, floor(target)::bigint - whole as rest from summed)
select doc_id, size, s::bigint as source_size, target,
       (case when target >= s then size else 0 end + case
          when upto <= rest then size
          when upto - tied >= rest then 0
          else ((rest - (upto - tied)) * size) // tied end)::bigint as taken, source
from left_over"""

_OP6 = r"""
with recursive rows_ as (select conv_id, turn, role, text, string_split(coalesce(text, ''), chr(10)) as lines from conversations),
leveled as (
  select conv_id, turn, role, text, lines, list_transform(lines, lambda x: len(regexp_extract_all(regexp_extract(x, '^[ \t]*(?:>[ \t]*)+'), '>'))) as lv
  from rows_),
own as (
  select conv_id, turn, role, lines, lv, regexp_replace(array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i:
           lv[i] = 0 and not (regexp_matches(lines[i], '(?i)(?:wrote|writes|said|schrieb|schreibt|a écrit|écrit|escribió|escribe)[ \t]*:[ \t]*$')
                              and coalesce(lv[i + 1], 0) > 0)), lambda i: lines[i]), chr(10)), '^\s+|\s+$', '', 'g') as own_text
  from leveled),
quoted as (
  select distinct conv_id, turn, lv[i] as level, trim(regexp_replace(lower(regexp_replace(lines[i], '^[ \t]*(?:>[ \t]*)+', '')), '\s+', ' ', 'g')) as passage
  from (select *, unnest(range(1, len(lines) + 1)) as i from own) where lv[i] > 0 and conv_id is not null and turn is not null),
firsts as (
  select conv_id, passage, min(turn) as origin from (
    select conv_id, turn, trim(regexp_replace(lower(unnest(string_split(own_text, chr(10)))), '\s+', ' ', 'g')) as passage
    from own where conv_id is not null and turn is not null) where passage <> '' group by all),
linked as (
  select q.*, case when f.origin < q.turn then f.origin end as origin
  from quoted q left join firsts f on q.conv_id = f.conv_id and q.passage = f.passage),
votes as (select conv_id, turn, level, origin, count(*) filter (passage <> '') as n from linked group by all),
links as (
  select conv_id, turn, sum(n) as n_quoted, max(level) as max_level, sum(n) filter (origin is not null) as n_linked,
         arg_min(origin, {'l': level, 'f': -n, 'e': -origin}) filter (origin is not null) as reply_to
  from votes group by all),
chain as (
  select conv_id, turn, reply_to as up, 1 as depth from links where reply_to is not null
  union all
  select c.conv_id, c.turn, l.reply_to, c.depth + 1 from chain c join links l on c.conv_id = l.conv_id and c.up = l.turn
  where l.reply_to is not null),
roots as (select conv_id, turn, arg_max(up, depth) as root, max(depth) as depth from chain group by all)
select o.conv_id, o.turn, o.role, o.own_text, coalesce(l.n_quoted, 0)::bigint as n_quoted, coalesce(l.max_level, 0)::bigint as max_level,
       coalesce(l.n_linked, 0)::bigint as n_linked, l.reply_to, coalesce(r.root, o.turn) as thread_turn, coalesce(r.depth, 0)::bigint as depth
from own o left join links l on o.conv_id = l.conv_id and o.turn = l.turn left join roots r on o.conv_id = r.conv_id and o.turn = r.turn"""


def _op7() -> str:
    separators, symbols = re.escape(line_rules.SEPARATORS).replace("|", "|"), line_rules.SYMBOLS
    closers = line_rules.CLOSERS.replace("'", "''").replace("]", r"\]")
    return rf"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
lines as (
  select r, i, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') as w from (
    select r, unnest(string_split(text, chr(10))) as x, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from docs)
  where regexp_matches(x, '[^\x20\x09-\x0D]')),
judged as (
  select r, i, x, w, len(w) as n, (
    (regexp_matches(x, '[{separators}]') and 5 * len(regexp_extract_all(x, '[{separators}]')) >= len(w))
    or (len(w) < {line_rules.UNFINISHED_WORDS} and not regexp_matches(w[-1], '[{closers}]$'))
    or (len(w) <= {line_rules.BOILERPLATE_WORDS} and regexp_matches(x, '(?i)(^|[^\p{{L}}\p{{N}}_])(?:{line_rules.BOILERPLATE})([^\p{{L}}\p{{N}}_]|$)|©'))
    or 2 * len(regexp_extract_all(x, '[{symbols}]')) >= len(w)
    or (len(w) >= 3 and not regexp_matches(x, '\p{{Ll}}') and len(regexp_extract_all(x, '\p{{Lu}}')) >= 6)
    or (len(w) >= 10 and 3 * list_unique(w) <= len(w))) as fails
  from lines),
by_line as (
  select r, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines, count(*) filter (fails) as n_failed_lines,
         coalesce(sum(n) filter (fails), 0) as lost_words
  from judged group by r),
words as (select r, row_number() over (partition by r order by i, k) as p, word from (
  select r, i, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from judged)),
five as (
  select r, p, word || chr(31) || lead(word, 1) over o || chr(31) || lead(word, 2) over o || chr(31) || lead(word, 3) over o
         || chr(31) || lead(word, 4) over o as run from words window o as (partition by r order by p)),
twice as (select r, p from (select r, p, count(*) over (partition by r, run) as c from five where run is not null) where c > 1),
covered as (select r, count(distinct p + k) as n from twice, range(5) t(k) group by r),
sums as (select r, count(*) as n_words, sum(len(word)) as word_chars from words group by r)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
       len(regexp_extract_all(text, '[{symbols}]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
       coalesce(c.n, 0)::bigint as n_repeat_words,
       coalesce(n_words, 0) < {line_rules.LEAST_WORDS} or 100 * coalesce(c.n, 0) > {line_rules.MOST_REPEATED} * n_words as base_failed,
       not base_failed and 2 * lost_words <= n_words as kept,
       coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_failed_lines, 0)::bigint as n_failed_lines, coalesce(lost_words, 0)::bigint as lost_words
from docs left join by_line using (r) left join sums using (r) left join covered c using (r)"""


def _op10() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    templates = ", ".join(
        f"({text(t.name)}, [{', '.join(map(text, t.bigrams))}], {str(t.name in licences.TEMPLATES).lower()})" for t in licences.template_bigrams(licences.TEMPLATES | licences.PASSAGES))
    anchors = ", ".join(f"({text(t.name)}, {text(a)}, {k}, {t.words})"
                        for t in licences.template_bigrams(licences.TEMPLATES | licences.PASSAGES) for a, k in t.anchors)
    known = ", ".join(sorted({text(a) for t in licences.template_bigrams(licences.TEMPLATES | licences.PASSAGES) for a, _ in t.anchors}))
    t = licences.THRESHOLD
    return rf"""
with templates(name, own, whole) as (values {templates}),
anchors(name, anchor, place, words) as (values {anchors}),
docs as (select row_number() over () as r, doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') as normal from documents),
lined as (select r, doc_id, normal, list_filter(string_split(normal, chr(10)), lambda x: contains(trim(x), ' ')) as lines from docs),
units as (select r, doc_id, case when len(lines) > 1 then list_append(lines, replace(normal, chr(10), ' ')) else lines end as units from lined),
split_ as (select r, u, list_filter(string_split(unit, ' '), lambda w: w <> '') as w from (
  select r, unnest(units) as unit, unnest(range(1, len(units) + 1)) as u from units)),
pairs as (select r, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as pairs from split_),
near as (
  select r, u, name, len(own) as size, 2.0 * len(list_intersect(pairs, own)) / (len(pairs) + len(own)) as dice
  from pairs join templates on whole and len(pairs) >= len(own) * {t} / (2 - {t}) - 1e-9 and len(pairs) <= len(own) * (2 - {t}) / {t} + 1e-9),
compared as (select r, count(distinct u) as n from near group by r),
best as (select r, u, arg_min(name, {{'d': -dice, 's': -size, 'n': name}}) as name, max(dice) as dice, arg_min(size, {{'d': -dice, 's': -size, 'n': name}}) as size
         from near where dice >= {t} - 1e-12 group by r, u),
texts as (select r, list_filter(string_split(replace(normal, chr(10), ' '), ' '), lambda w: w <> '') as w from docs),
hits as (select r, unnest(list_filter(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1] in ({known}))) as i
         from texts),
starts as (select r, i - place as start, name, greatest(i - place, 1) as a, least(i - place + words, len(w) + 1) as b, w
           from hits join texts using (r) join anchors on anchor = w[i] || ' ' || w[i + 1]),
windows as (select r, start, name, list_distinct(list_transform(range(a, b - 1), lambda j: w[j] || ' ' || w[j + 1])) as pairs from starts),
passing as (select r, start, name, len(own) as size, 2.0 * len(list_intersect(pairs, own)) / (len(pairs) + len(own)) as dice
            from windows join templates using (name)),
passages as (select r, arg_min(name, {{'d': -dice, 's': -size, 'n': name}}) as name, max(dice) as dice, arg_min(size, {{'d': -dice, 's': -size, 'n': name}}) as size
             from passing where dice >= {t} - 1e-12 group by r, start),
every as (select r, name, dice, size, 0 as passage from best union all select r, name, dice, size, 1 from passages),
found as (select r, sum(1 - passage) as n, sum(passage) as n_passages, arg_min(name, {{'d': -dice, 's': -size, 'n': name}}) as licence, max(dice) as dice,
                 array_to_string(list_sort(list_distinct(list(name))), ',') as licences from every group by r)
select doc_id, len(units)::bigint as n_units, coalesce(c.n, 0)::bigint as n_candidates, coalesce(f.n, 0)::bigint as n_matches,
       coalesce(f.n_passages, 0)::bigint as n_passages,
       licence, round(dice::double, 9) as dice, coalesce(licences, '') as licences
from units left join compared c using (r) left join found f using (r)"""


# CRC-32 of an id's digits goes bit by bit; turns that share a number don't occur in the given tables.
_OP12 = r"""
with turns as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first) as own
  from conversations where conv_id is not null group by conv_id),
hashed as (
  select conv_id, own, xor(list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, s: case when s >= 0 then xor(a, s) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % 9 as h
  from turns),
built as (
  select c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) as seq
  from hashed c left join hashed b on b.conv_id = c.conv_id - c.conv_id % 5),
members as (select conv_id, len(seq) as size, seq, unnest(range(0, len(seq) + 1)) as depth from built),
nodes as (
  select seq[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = depth), '')) as ends_sha256
  from members group by all),
up as (select path, unnest(range(0, depth + 1)) as above, (n_convs - 1) * case when depth > 0 then strlen(path[depth].text) else 0 end as saved from nodes),
kids as (select path[1:depth - 1] as path, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by all),
sums as (
  select up.path[1:above] as path, above as depth, sum(saved) as saved, count(*) filter (k.n is null) as leaves
  from up left join kids k on k.path = up.path and k.depth = len(up.path) group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0)::bigint as n_children,
       s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join sums s on s.path = n.path and s.depth = n.depth
left join kids k on k.path = n.path and k.depth = n.depth
left join nodes p on p.path = n.path[1:n.depth - 1] and p.depth = n.depth - 1"""


ORACLES = {"op3_source_mix": _OP3, "op6_quotation_threads": _OP6, "op7_line_rules": _op7(), "op10_licence_scan": _op10(),
           "op12_conversation_trie": _OP12}
