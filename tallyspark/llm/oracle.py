"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tallyspark.llm import chat, codes, quality, topk, url_filter

_SPACE = r"[\x20\x09-\x0D]"
# The words of a text, and a text's characters without those of a set.
_WORDS = rf"list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '')"
_SYMBOLS = "[#*$%&|<>]"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _rule(rule: quality.Rule) -> str:
    value = f"({rule.measure} / nullif({rule.per}, 0))"
    bounds = [f"{value} >= {rule.least}"] * (rule.least is not None) + [f"{value} <= {rule.most}"] * (rule.most is not None)
    return f"coalesce(({' and '.join(bounds)}) or n_words < {rule.from_words}, true)"


_QUALITY = rf"""with split as (
    select row_number() over () as k, doc_id, coalesce(text, '') as body, {_WORDS} as w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents
), windows as (
    select k, i, w[i:i + {quality.WINDOW - 1}] as v from (select k, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) as i from split)
), twice as (
    select k, i from (select k, i, count(*) over (partition by k, v) as n from windows) where n > 1
), covered as (
    select k, count(distinct i + d) as n from twice, range({quality.WINDOW}) r(d) group by k
), measured as (
    select doc_id, len(w)::bigint as n_words, length(regexp_replace(body, '{_SPACE}', '', 'g'))::bigint as word_chars,
        (length(body) - length(regexp_replace(body, '{_SYMBOLS}', '', 'g')))::bigint as n_symbols,
        len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(covered.n, 0)::bigint as n_repeat_words,
        len(list_filter(w, lambda x: list_contains({_list(quality.STOP_WORDS)}, x)))::bigint as n_stop_words
    from split left join covered using (k)
)
select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed,
    not base_failed and {" and ".join(map(_rule, quality.RULES))} as kept from measured"""

_TOP = f"""with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(x::double * {topk.SCALE})) as v from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
    select q.vec_id as query_id, r.vec_id, list_inner_product(q.v, r.v)::bigint as score
    from vectors q join vectors r on q.vec_id % {topk.EVERY} = 0 and q.vec_id <> r.vec_id and len(q.v) = len(r.v)
)
select query_id, rank::int as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores
) where rank <= {topk.TOP}"""

# A SHA-1 in base32: 32 digits of five bits each.
_WARC = """with payloads as (
    select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as sha from pages
), digits as (
    select *, min(page_id) over (partition by sha) as first_id,
        list_aggregate(list_transform(range(4), lambda part: list_aggregate(list_transform(range(8), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
            ((('0x' || sha[part * 10 + 1:part * 10 + 10])::bigint >> (35 - 5 * k)) & 31)::int + 1]), 'string_agg', '')), 'string_agg', '') as digest
    from payloads
)
select page_id, octet_length(encode(body))::bigint as payload_bytes, digest as payload_digest,
    case when page_id = first_id then 'response' else 'revisit' end as record_type,
    case when page_id <> first_id then first_id end as refers_to from digits"""


def _fits(rule: url_filter.Rule) -> str:
    return f"(host = '{rule.host}' or suffix(host, '.{rule.host}')) and starts_with(path, '{rule.path}')"


def _terms(terms: list[str]) -> str:
    bounded = [f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::int" for t in terms]
    return " + ".join(bounded)


_BY_LENGTH = sorted(url_filter.RULES, key=lambda r: (-len(r.name), r.name))
_URLS = rf"""with cut as (
    select page_id, coalesce(url, '') as url, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') as rest from pages
), parts as (
    select page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut
), judged as (
    select *, case {" ".join(f"when {_fits(r)} then '{r.name}'" for r in _BY_LENGTH)} end as rule,
        ({_terms(url_filter.STRICT)})::int as strict_terms, ({_terms(url_filter.SOFT)})::int as soft_terms from parts
)
select page_id, host, path, rule, strict_terms, soft_terms, case
    when rule in ({", ".join(f"'{r.name}'" for r in _BY_LENGTH if r.allow)}) then 'allow' when rule is not null then 'block'
    when strict_terms > 0 or soft_terms >= {url_filter.SOFT_HITS} then 'block' else 'allow' end as verdict from judged"""


def _escaped(column: str) -> str:
    return f"replace(coalesce({column}, ''), '{chat.MARK}', '{chat.ESCAPED}')"


# A conversation's turns as a list; one is dropped if it begins a longer list or equals that of a smaller id.
_CHAT = f"""with numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, "text" nulls first) - 1 as place
    from conversations
), convs as (
    select conv_id, list({{'r': role, 't': "text"}} order by place) as turns, count(*)::bigint as n_turns from numbered group by conv_id
), prefixes as (
    select distinct turns[1:k] as turns from (select turns, unnest(range(1, n_turns)) as k from convs)
), kept as (
    select min(conv_id) as conv_id, any_value(n_turns) as n_turns from convs anti join prefixes using (turns) group by turns
)
select conv_id, n_turns, place // {chat.SEGMENT} as segment,
    string_agg('{chat.OPEN}' || {_escaped("role")} || chr(10) || {_escaped('"text"')} || '{chat.CLOSE}' || chr(10), '' order by place) as rendered
from kept join numbered using (conv_id) group by all"""



def _nearest(name: str, book: str) -> str:
    """Each part's nearest entry and its squared distance; the lower number first among equals."""
    off = "(w[i] - c[i]) * (w[i] - c[i])"
    return f"""{name} as (
    select k, p, any_value(w) as w, min(d * {codes.ENTRIES} + e) % {codes.ENTRIES} as e, min(d) as d from (
        select k, p, w, e, list_sum(list_transform(range(1, len(w) + 1), lambda i: {off}))::bigint as d
        from parts join {book} using (p)
    ) group by k, p
)"""


def _means(name: str, assigned: str, book: str) -> str:
    """The floored means of each entry's parts; entries without any stay."""
    return f"""{name} as (
    select p, e, coalesce(m, c) as c from {book} left join (
        select p, e, list(m order by i) as m from (
            select p, e, i, floor(sum(w[i]) / count(*))::bigint as m from {assigned}, range(1, len(w) + 1) r(i) group by p, e, i
        ) group by p, e
    ) using (p, e)
)"""


# All vectors of the test tables have one length, which the parts divide.
_CODES = f"""with kept as (
    select *, row_number() over (order by vec_id, v) - 1 as k from (
        select vec_id, label, list_transform(embedding, lambda x: floor(x::double * {codes.SCALE})::bigint) as v from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    )
), parts as (
    select k, p, v[p * len(v) // {codes.PARTS} + 1:(p + 1) * len(v) // {codes.PARTS}] as w from kept, range({codes.PARTS}) r(p)
), book0 as (
    select p, k as e, w as c from parts where k < {codes.ENTRIES}
), {_nearest("near0", "book0")}, {_means("book1", "near0", "book0")},
{_nearest("near1", "book1")}, {_means("book2", "near1", "book1")}, {_nearest("near2", "book2")},
coded as (
    select k, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from near2 group by k
)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, (
    select sha256(string_agg(x::varchar, ',' order by p, e, i)) from (select p, e, i, c[i] as x from book2, range(1, len(c) + 1) r(i))
) as codebooks_sha256 from kept join coded using (k)"""

ORACLES = {
    "op2_quality_rules": _QUALITY,
    "op3_topk": _TOP,
    "op4_warc": _WARC,
    "op7_url_filter": _URLS,
    "op8_chat_format": _CHAT,
    "op11_vector_codes": _CODES,
}
