"""DuckDB SQL for the queries that SQL can express; it takes other routes than the operators do."""

from __future__ import annotations

from tallyhouse.llm import line_rules as L
from tallyhouse.llm import url_templates as U

BLANKS = r"[\x20\x09-\x0D]+"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{BLANKS}'), lambda x: x <> '')"


def _times(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def line_rules() -> str:
    """Words, windows and lines are rows here, counted by grouping instead of inside arrays."""
    good = f"""
        {_times('line', L.SYMBOLS)} * 5 <= n and {_times('line', '!')} * 2 <= n and {_times('line', '[|»›•·]')} * 5 <= n
        and not (n >= 3 and not regexp_matches(line, '\\p{{Ll}}') and regexp_matches(line, '\\p{{Lu}}{{2}}'))
        and not (n <= 30 and regexp_matches(lower(line), '{"|".join(L.BOILERPLATE)}'))
        and not (n >= 10 and len(list_distinct(w)) * 3 < n)"""
    return f"""
    with texts as (select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
    word as (select k, unnest({_words('text')}) as w, generate_subscripts({_words('text')}, 1) as i from texts),
    grams as (
        select k, i, w, lead(w, 1) over r as w2, lead(w, 2) over r as w3 from word window r as (partition by k order by i)),
    often as (select k, i, count(*) over (partition by k, w, w2, w3) > 1 as twice from grams where w3 is not null),
    covered as (select k, count(distinct i + d) as n_repeat_words from often, unnest([0, 1, 2]) t(d) where twice group by k),
    sums as (select k, count(*) as n_words, sum(length(w)) as word_chars from word group by k),
    line as (select k, unnest(string_split(text, chr(10))) as line from texts),
    worded as (select k, line, {_words('line')} as w, len({_words('line')}) as n from line where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
    repeated as (select k, count(*) - count(distinct line) as n_dup_lines from worded group by k),
    cleaned as (select k, sum(n) as kept_words from (select distinct k, line, n from worded where {good}) d group by k),
    counts as (
        select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
            {_times('text', L.SYMBOLS)}::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
            coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(kept_words, 0)::bigint as kept_words
        from texts left join sums using (k) left join covered using (k) left join repeated using (k) left join cleaned using (k)),
    failed as (select *, n_words < {L.MIN_WORDS} or 100 * n_repeat_words > {L.MAX_REPEAT_PERCENT} * n_words as base_failed from counts)
    select *, not base_failed and 100 * kept_words >= {L.KEEP_PERCENT} * n_words as kept from failed"""


def archives() -> str:
    """Base32 digits of the SHA-1 are cut from five hexadecimal digits at a time."""
    digit = f"substr('{BASE32}', ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int + 1, 1)"
    return f"""
    with pages_ as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
    held as (select *, max(page_id) over (partition by html) as holder from pages_)
    select page_id, octet_length(encode(html))::bigint as payload_bytes,
        list_aggregate(list_transform(range(32), lambda i: {digit}), 'string_agg', '') as payload_digest,
        case when page_id = holder or holder is null then 'response' else 'revisit' end as record_type,
        case when page_id is distinct from holder then holder end as refers_to
    from held"""


def url_filters(rules: list[U.Rule], purity: float = U.PURITY, levels: int = 6) -> str:
    """One pair of steps for each level of the tree, first downwards for wildcards, then upwards for merging.

    ``levels`` must reach the deepest path of the tables at hand.
    """
    fits = [f"when (host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}') then '{r.verdict} {r.name}'"
            for r in sorted(rules, key=lambda r: (-len(r.name), r.name))]
    stem, suffix = r"regexp_replace(s, '\.[A-Za-z]{2,5}$', '')", r"regexp_extract(s, '(\.[A-Za-z]{2,5})$', 1)"
    general = f"case when regexp_matches({stem}, '{U.VARIES}') then '*' || {suffix} else s end"
    steps = [f"""
    urls as (
        select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
    ruled as (select *, case {" ".join(fits)} end as fit, list_filter(string_split(path, '/'), lambda x: x <> '') as whole from urls),
    found as (
        select page_id, host, path, fit, split_part(fit, ' ', 2) as rule, split_part(fit, ' ', 1) as told,
            list_transform(whole, lambda s: {general}) as parts from ruled),
    t0 as (
        select host, parts, parts as template, count(*) as pages, count(fit) as known,
            count(*) filter (where told = 'allow') as good from found group by host, parts)"""]
    for level in range(1, levels + 1):
        above = f"template[1:{level - 1}]"
        steps.append(f"""
    c{level} as (
        select host, above from (select host, {above} as above, template[{level}] as child, count(*) as paths from t{level - 1} where len(template) >= {level} group by all) x
        group by host, above having count(*) >= {U.MANY} and count(*) >= {U.SPREAD} * sum(paths)),
    t{level} as (
        select t.* replace (case when c.host is not null and len(template) >= {level}
            then list_concat(list_append({above}, '*'), template[{level + 1}:]) else template end as template)
        from t{level - 1} t left join c{level} c on t.host = c.host and t.{above} = c.above)""")
    steps.append(f"g{levels + 1} as (select *, template as grp, true as open from t{levels})")
    for level in range(levels, 0, -1):
        steps.append(f"""
    n{level} as (
        select host, grp, grp[1:{level - 1}] as node, sum(good)::double as good, sum(known)::double as known
        from g{level + 1} where open and len(grp) = {level} group by host, grp having sum(known) > 0),
    m{level} as (
        select *, (sum(good) over w + 1) / (sum(known) over w + 2) as q from n{level} window w as (partition by host, node)),
    a{level} as (select host, grp, node, not abs(good - known * q) > {U.ALIKE} * sqrt(known * q * (1 - q)) as alike from m{level}),
    g{level} as (
        select g.* replace (case when a.alike then a.node else g.grp end as grp, case when g.open and len(g.grp) = {level} then coalesce(a.alike, false) else g.open end as open)
        from g{level + 1} g left join a{level} a on g.host = a.host and g.grp = a.grp and g.open)""")
    neutral = f"({U.PRIOR} + {U.UNKNOWN} * (pages - known))"
    steps.append(f"""
    sums as (select host, grp, open, sum(good)::double as good, sum(known)::double as known, sum(pages)::double as pages from g1 group by host, grp, open),
    hosts as (select sum(good) as good, sum(known) as known from t0 group by host having sum(known) > 0),
    whole as (select coalesce(sum(((good + 1) * 1000000 // (known + 2))::bigint)::double / nullif(1000000 * count(*), 0), 1.0) as general from hosts),
    pure as (select host, grp, open, (good + {neutral} * general) / (known + {neutral}) as purity from sums, whole)
    select page_id, f.host, path, rule, coalesce(told, case when purity < {purity} then 'block' else 'allow' end) as verdict,
        '/' || array_to_string(g.grp, '/') as template, purity
    from found f join g1 g on f.host = g.host and f.parts = g.parts join pure p on g.host = p.host and g.grp = p.grp and g.open = p.open""")
    return "with " + ",".join(steps)


def exact_copies() -> str:
    """Whole normalised texts are compared here, by windows."""
    return f"""
    with normal as (select doc_id, regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g') as text from documents)
    select doc_id, min(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size,
        row_number() over (partition by text order by doc_id nulls last) = 1 as kept, sha256(text) as text_sha256
    from normal"""


def collocations(longest: int = 5, least: int = 100, top: int = 2000) -> str:
    """Every phrase of every length is counted here, without bounds; longer candidates are searched at any distance."""
    grams = " union all ".join(
        f"select lang, piece, i, {m} as m, array_to_string(list(w) over (partition by piece order by i rows between current row and {m - 1} following), ' ') as phrase, "
        f"count(*) over (partition by piece order by i rows between current row and {m - 1} following) as got from word" for m in range(1, longest + 1))
    return rf"""
    with texts as (
        select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
    pieces as (select lang, unnest(string_split_regex(text, '[.,;:!?
-
]')) as piece from texts),
    numbered as (select lang, row_number() over () as piece, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
    word as (select lang, piece, unnest(w) as w, generate_subscripts(w, 1) as i from numbered),
    totals as (select lang, count(*) as n from word group by lang),
    counted as (select lang, m, phrase, count(*) as f from ({grams}) g where got = m group by all having count(*) >= {least}),
    candidates as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from counted where m > 1),
    cut as (select *, unnest(range(1, m)) as k from candidates),
    parts as (
        select c.lang, c.phrase, c.a, k, l.f as l, r.f as r, n, (1000 * c.a::hugeint * n::hugeint) // (l.f::hugeint * r.f::hugeint) as score
        from cut c join counted l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:k], ' ')
        join counted r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ') join totals t on t.lang = c.lang),
    lowest as (select * from parts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inside as (
        select c.lang, array_to_string(c.w[s:s + m2 - 1], ' ') as phrase, max(c.a) as longer
        from (select *, unnest(range(2, m)) as m2 from candidates) c, lateral (select unnest(range(1, c.m - c.m2 + 2)) as s) p group by all),
    kept as (select x.* from lowest x left join inside i on i.lang = x.lang and i.phrase = x.phrase where longer is null or 100 * longer < 100 * a),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
    select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked where rank <= {top}"""
