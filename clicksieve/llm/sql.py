"""DuckDB SQL for the queries that SQL can express."""

from clicksieve.llm.hard_negatives import LOW_PERCENT, NEGATIVES, POSITIVES, SCALE
from clicksieve.llm.line_dedup import MIN_CHARS, MIN_DOCUMENTS
from clicksieve.llm.quality_rules import LENGTHS, MAX_LINE_SHARE, MAX_NGRAM_SHARE, MAX_REPEATED_PERCENT, MIN_WORDS
from clicksieve.llm.sharding import N_SHARDS, ROW_BYTES
from clicksieve.llm.source_audit import MIN_DOCUMENTS as AUDIT_DOCUMENTS
from clicksieve.llm.source_audit import TOP_TERMS, UNIT

# CRC-32 of each half byte.
CRC_OF_NIBBLE = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)

SHARDING = f"""
with sized as (
  select doc_id, coalesce(strlen(text), 0) + {ROW_BYTES} as size, coalesce(md5(text), '') as digest,
         coalesce(doc_id, -9223372036854775808) as tie, string_split(hex(encode(coalesce(text, ''))), '') as digits
  from documents),
-- Half a byte at a time, the lower half first.
summed as (
  select * exclude (digits),
         xor(list_reduce(
           list_transform(range(0, case when digits = [''] then 0 else len(digits) end),
                          lambda i: (instr('0123456789ABCDEF', digits[xor(i, 1) + 1]) - 1)::bigint),
           lambda crc, half: xor({CRC_OF_NIBBLE}[(xor(crc, half) & 15) + 1]::bigint, crc >> 4),
           4294967295::bigint), 4294967295::bigint) as text_crc32
  from sized),
placed as (
  select *, row_number() over (order by digest, tie) as place,
         sum(size) over (order by digest, tie rows unbounded preceding) as b_with, sum(size) over () as total
  from summed),
sharded as (select *, cast((b_with - size // 2 - 1) * {N_SHARDS} // total as int) as shard from placed)
select doc_id, cast(size as bigint) as size, text_crc32, 'bytes' as law, shard,
       row_number() over (partition by shard order by place) - 1 as slot, null::int as grown_shard
from sharded"""


def _share(n: int) -> str:
    """The characters in n-grams that were there before, for each doc."""
    return f"""
grams{n} as (select doc, pos, row_number() over (partition by doc, gram order by pos) as nth from (
  select doc, pos, string_agg(word, ' ') over (partition by doc order by pos rows between current row and {n - 1} following) as gram,
         count(*) over (partition by doc order by pos rows between current row and {n - 1} following) as held
  from words) where held = {n}),
share{n} as (select words.doc, sum(length(word)) as chars from words
  semi join (select distinct doc, pos + unnest(range(0, {n})) as pos from grams{n} where nth > 1) as again
  on words.doc = again.doc and words.pos = again.pos group by words.doc)"""


QUALITY_RULES = f"""
with docs as (select row_number() over () as doc, doc_id, coalesce(text, '') as text from documents),
words as (select doc, unnest(found) as word, generate_subscripts(found, 1) as pos from (
  select doc, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as found from docs)),
counted as (select doc, count(*) as n_words, sum(length(word)) as word_chars from words group by doc),
text_lines as (select doc, ln, pos, row_number() over (partition by doc, ln order by pos) as nth from (
  select doc, unnest(found) as ln, generate_subscripts(found, 1) as pos from (
    select doc, string_split(text, chr(10)) as found from docs))
  where regexp_matches(ln, '[^\\x20\\x09-\\x0D]')),
repeated as (select doc, count(*) as n_dup_lines,
    sum(length(regexp_replace(ln, '[\\x20\\x09-\\x0D]+', '', 'g'))) as chars from text_lines where nth > 1 group by doc),
threes as (select doc, pos, count(*) over (partition by doc, gram) as n from (
  select doc, pos, string_agg(word, ' ') over (partition by doc order by pos rows between current row and 2 following) as gram,
         count(*) over (partition by doc order by pos rows between current row and 2 following) as held
  from words) where held = 3),
covered as (select doc, count(*) as n_repeat_words from (
  select distinct doc, pos + unnest(range(0, 3)) as pos from threes where n > 1) group by doc),
{",".join(map(_share, LENGTHS))},
measured as (
  select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         greatest({", ".join(f"coalesce(share{n}.chars, 0)" for n in LENGTHS)})::double / greatest(word_chars, 1) as ngram_share,
         coalesce(repeated.chars, 0)::double / greatest(word_chars, 1) as line_share
  from docs left join counted using (doc) left join repeated using (doc) left join covered using (doc)
  {" ".join(f"left join share{n} using (doc)" for n in LENGTHS)}),
judged as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed from measured)
select *, not base_failed and ngram_share <= {MAX_NGRAM_SHARE} and line_share <= {MAX_LINE_SHARE} as kept from judged"""


# Each scored pair by the inner product of whole numbers; the windows hold whatever the order of the scores.
HARD_NEGATIVES = f"""
with whole as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.r as anchor, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
  from whole a join whole b on a.r <> b.r where a.vec_id % 100 = 0),
near as (
  select * from (select anchor, anchor_id, r as positive, vec_id as positive_id, score as positive_score,
                        row_number() over (partition by anchor order by score desc, vec_id, r) as place from scored where same)
  where place <= {POSITIVES}),
hard as (
  select near.*, vec_id as negative_id, score as negative_score,
         row_number() over (partition by near.anchor, positive order by score desc, vec_id, r) as rank
  from near join scored on near.anchor = scored.anchor and not same
    and {LOW_PERCENT} * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from hard where rank <= {NEGATIVES}"""

WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
with docs as (select row_number() over () as doc, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
text_lines as (select doc, doc_id, ln, pos, translate(trim(ln, {WHITE}), {LOWER}) as key
  from (select doc, doc_id, unnest(lines) as ln, generate_subscripts(lines, 1) as pos from docs)),
held as (select key, min(doc_id) as owner from text_lines where length(key) >= {MIN_CHARS}
  group by key having count(distinct doc_id) >= {MIN_DOCUMENTS}),
marked as (select text_lines.*, owner is not null and owner <> doc_id as gone from text_lines left join held using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(ln, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc, doc_id"""

SOURCE_AUDIT = f"""
with docs as (select row_number() over () as doc, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
found as (select doc, lang, source, unnest(regexp_extract_all(translate(text, {LOWER}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as lang_n from found group by all having count(distinct doc) >= {AUDIT_DOCUMENTS}),
sized as (select lang, count(*) as v, sum(lang_n) as lang_total from kept group by lang),
counted as (select lang, source, term, count(*) as n from found join kept using (lang, term) group by all),
groups as (select lang, source, coalesce(v, 0)::hugeint as v, coalesce(lang_total, 0)::hugeint as lang_total, coalesce(total, 0)::hugeint as total
  from (select distinct lang, source from docs) left join sized using (lang)
  left join (select lang, source, sum(n) as total from counted group by all) using (lang, source)),
shares as (select lang, source, term, coalesce(n, 0) as n, 1 + {UNIT} * (coalesce(n, 0)::hugeint + 2) // (total + 2 * v) as p,
    1 + {UNIT} * (lang_n::hugeint + 2) // (lang_total + 2 * v) as q
  from groups join kept using (lang) left join counted using (lang, source, term)),
pairs as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source as one, y.source as other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) as value
    from shares x join shares y on x.lang = y.lang and x.term = y.term group by all) as sums
  on a.lang = sums.lang and one = a.source and other = b.source),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all
  select * from (
    select lang, source, 'term' as part, term as item, (p - q) * (p - q) // (p + q) as value,
           row_number() over (partition by lang, source order by (p - q) * (p - q) // (p + q) desc, term) as rank
    from shares where n > 0 and p > q) where rank <= {TOP_TERMS})
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_sharding": SHARDING,
        "op8_quality_rules": QUALITY_RULES,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_line_dedup": LINE_DEDUP,
        "op13_source_audit": SOURCE_AUDIT,
    }
