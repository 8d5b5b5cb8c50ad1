"""SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

from shelfcast.llm import lm_scoring, quality_rules

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

EXACT_DEDUP = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""

#: The checksum of a short ASCII text, bit by bit.
_CRC_STEP = "(case when j % 8 = 0 then xor(crc, ascii({s}[j // 8 + 1])) else crc end)"
_CRC = (
    "xor(list_reduce(range(0, 8 * len({s})), lambda crc, j: case when " + _CRC_STEP + " & 1 = 1 then xor(" + _CRC_STEP
    + " >> 1, 3988292384) else " + _CRC_STEP + " >> 1 end, 4294967295::bigint), 4294967295)"
)

_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

MERKLE = f"""
with recursive leaves as (
    select doc_id, source, {_LEAF.format(text="text")} as leaf,
           case when {_CRC.format(s="(doc_id::varchar)")} % 5 = 0 then {_LEAF.format(
               text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
           )} end as claimed
    from documents
), placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from leaves
), levels as (
    select source, 0 as level, list(leaf order by pos) as nodes from placed group by source
    union all
    select source, level + 1, list_transform(range(0, (len(nodes) + 15) // 16),
                                             lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], '')))
    from levels where len(nodes) > 1
), subroots as (
    select source, nodes[1] as subroot, row_number() over (order by source nulls first) - 1 as place
    from levels where len(nodes) = 1
), upper as (
    select 0 as level, list(subroot order by place) as nodes from subroots having count(*) > 0
    union all
    select level + 1, list_transform(range(0, (len(nodes) + 15) // 16),
                                     lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], '')))
    from upper where len(nodes) > 1
), runs as (
    select p.source, p.pos, level, p.pos // pow(16, level)::bigint as spot, nodes
    from placed p join levels l on l.source is not distinct from p.source where len(nodes) > 1
    union all
    select p.source, p.pos, 1000 + level, place // pow(16, level)::bigint, nodes
    from placed p join subroots s on s.source is not distinct from p.source, upper where len(nodes) > 1
), steps as (
    select source, pos, row_number() over (partition by source, pos order by level) as step,
           array_to_string(nodes[spot // 16 * 16 + 1:spot], '') as before,
           array_to_string(nodes[spot + 2:spot // 16 * 16 + 16], '') as after
    from runs
), folds as (
    select source, pos, 0 as step, coalesce(claimed, leaf) as node from placed
    union all
    select f.source, f.pos, s.step, sha256(before || node || after)
    from folds f join steps s on s.source is not distinct from f.source and s.pos = f.pos and s.step = f.step + 1
), proofs as (
    select source, pos, sha256(string_agg(before || after, '' order by step)) as proof from steps group by source, pos
), roots as (select source, pos, arg_max(node, step) as folded_root from folds group by source, pos)
select doc_id, leaf, subroot, root, coalesce(proof, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
from placed p join subroots s on s.source is not distinct from p.source
join roots r on r.source is not distinct from p.source and r.pos = p.pos
left join proofs q on q.source is not distinct from p.source and q.pos = p.pos,
(select nodes[1] as root from upper where len(nodes) = 1)
"""

PREFIX_TRIE = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    where conv_id is not null
), own as (
    select conv_id, {_CRC.format(s="(conv_id::varchar)")} % 4 as h, list({{'role': role, 'text': text}}
           order by turn nulls first, substr(sha256(strlen(role) || ':' || role || text), 1, 32)) as own
    from turns group by conv_id
), rebuilt as (
    select c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) as turns
    from own c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
), nodes as (
    select path, len(path) as depth, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(turns) = len(path)), '')) as ends
    from (select conv_id, turns, turns[1:unnest(range(0, len(turns) + 1))] as path from rebuilt) group by path
), kids as (select path[1:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by all
), valued as (
    select nodes.*, coalesce(n_children, 0) as n_children, case when depth = 0 then 0 else (n_convs - 1) *
           len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) end as saved
    from nodes left join kids using (path)
), below as (
    select over as path, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
    from (select *, path[1:unnest(range(0, depth + 1))] as over from valued) group by over
)
select v.conv_id, v.depth, p.conv_id as parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens,
       v.ends as ends_sha256
from valued v join below using (path) left join nodes p on v.depth > 0 and p.path = v.path[1:v.depth - 1]
"""

MIXING = r"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) || ':' || coalesce(source, '')) as key
    from documents
), sources as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place,
           [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
    from sized group by source
), levels as (
    select *, 3 * source_size as cap,
           sum(source_size) over () - coalesce(sum(3 * source_size) over before, 0) as rest,
           sum(weight) over onwards as shares, row_number() over by_ratio as rank
    from sources
    window by_ratio as (order by 3 * source_size / weight, place),
           before as (order by 3 * source_size / weight, place rows between unbounded preceding and 1 preceding),
           onwards as (order by 3 * source_size / weight, place rows between current row and unbounded following)
), goals as (
    select source, place, source_size, least(cap::double, weight * (
        select rest::double / shares::double from levels where cap * shares >= weight * rest order by rank limit 1
    )) as target from levels
), queued as (
    select s.*, g.place, g.source_size, g.target, sum(size) over (
        partition by g.place order by key rows between unbounded preceding and current row) as sent
    from sized s join goals g on s.source is not distinct from g.source
), copies as (
    select *, case when size > 0 and target > 0 then (e * source_size + sent)::double / target end as finish
    from queued, (select unnest([0, 1, 2]) as e)
), ordered as (
    select *, sum(size) over (order by finish, place, key, sent rows between unbounded preceding and current row) as total
    from copies where finish is not null
), taken as (
    select key, sum(size) as taken from ordered where total <= (select sum(size) from sized) group by key
)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from queued left join taken using (key)
"""

NGRAM_JOIN = r"""
with recursive worded as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, unnest(case when len(w) < 3 then [array_to_string(w, ' ')] else
        list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2]) end) as s
    from worded where len(w) > 0
), sized as (select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
    select x, y from shared join sized p on p.doc_id = x join sized q on q.doc_id = y
    where 100 * common >= 90 * (p.n + q.n - common)
), edges as (select x, y from links union all select y, x from links
), reached as (
    select doc_id, doc_id as other from documents
    union select r.doc_id, e.y from reached r join edges e on r.other = e.x
), lowest as (select doc_id, min(other) as component_id from reached group by doc_id
), degrees as (select x as doc_id, count(*) as n_links from edges group by x)
select doc_id, coalesce(n, 0) as n_shingles, component_id, coalesce(n_links, 0) as n_links
from lowest left join sized using (doc_id) left join degrees using (doc_id)
"""

LM_SCORING = rf"""
with worded as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), tokens as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from worded
), vocabulary as (select distinct word from tokens
), numbered as (select doc_id, pos, '=' || word as v from tokens
), pairs as (
    select doc_id, coalesce(lag(v) over (partition by doc_id order by pos), '^') as u, v from numbered
), own_pairs as (select doc_id, u, v, count(*) as n from pairs group by all
), own as (
    select doc_id, v as word, count(*) as n from numbered group by all
    union all select doc_id, '^', 1 from worded where len(w) > 0
), totals as (select word, sum(n) as n from own group by word
), pair_totals as (select u, v, sum(n) as n from own_pairs group by all
), sizes as (select doc_id, len(w) as n_words from worded
), parts as (
    select p.doc_id, p.n, t.n - p.n as pair, tu.n - ou.n as context, tv.n - ov.n + 1 as single,
           (select count(*) from tokens) + (select count(*) from vocabulary) + 2 - s.n_words as others
    from own_pairs p join pair_totals t using (u, v) join sizes s using (doc_id)
    join totals tu on tu.word = p.u join own ou on ou.doc_id = p.doc_id and ou.word = p.u
    join totals tv on tv.word = p.v join own ov on ov.doc_id = p.doc_id and ov.word = p.v
), summed as (
    select doc_id, sum(case when pair > 0 then 0 else n end) as n_backoff,
           sum(n * case when pair > 0 then ln(pair::double / context)
                        else ln({lm_scoring.ALPHA}) + ln(single::double) - ln(others::double) end) as log_score
    from parts group by doc_id
)
select doc_id, n_words::bigint as n_words, coalesce(n_backoff, 0)::bigint as n_backoff,
       round(coalesce(log_score, 0), 6) as log_score, round(log_score / n_words, 6) as mean_log_score
from sizes left join summed using (doc_id)
"""

_PLACED = """
{kind}_found as (
    select doc_id, text, regexp_extract_all(text, '{pattern}') as found, string_split_regex(text, '{pattern}') as pieces
    from texts where regexp_matches(text, '{pattern}')
), {kind}_placed as (
    select doc_id, '{kind}' as kind, {order} as ord, found[k] as match, text,
           (list_sum(list_transform(pieces[1:k], lambda x: len(x))) +
            coalesce(list_sum(list_transform(found[1:k - 1], lambda x: len(x))), 0))::bigint as start
    from (select *, unnest(range(1, len(found) + 1)) as k from {kind}_found)
)"""

_DIGITS = "regexp_replace(match, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, len({_DIGITS}) + 1), lambda k:
    (case when k % 2 = 1 then reverse({_DIGITS})[k]::int
          else (2 * reverse({_DIGITS})[k]::int) // 10 + (2 * reverse({_DIGITS})[k]::int) % 10 end))) % 10 = 0"""



def _near(words: str) -> str:
    """One of the words begins within the forty signs before or behind a match."""
    sides = ("substr(text, greatest(start - 39, 1), least(start, 40))", "substr(text, start + len(match) + 1, 40)")
    return "(" + " or ".join(rf"regexp_matches(lower({side}), '\b({words})')" for side in sides) + ")"


_PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "list_max(list_transform(string_split(match, '.'), lambda x: x::hugeint)) <= 255",
    ),
    "card": (r"[0-9]([\x20-]?[0-9])+", f"case when len({_DIGITS}) between 12 and 19 then {_LUHN} else false end"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"len({_DIGITS}) between 9 and 15"),
    "iban": (r"\b[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}\b", "{mod97}"),
    "ssn": (
        r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
        "not regexp_matches(match, '^(000|666|9)|-00-|-0000$') and " + _near("ssn|social|security|tax"),
    ),
    "secret": (
        r"\b([0-9a-f]{64}|[0-9a-f]{40})\b",
        "regexp_matches(match, '[0-9]') and regexp_matches(match, '[a-f]') and "
        + _near("token|secret|passw|pwd|credential|bearer|api|key|auth"),
    ),
}
_MOD97 = """list_reduce(list_transform(range(1, len(replace(match, ' ', '')) + 1), lambda k:
    ascii((replace(match, ' ', '')[5:] || replace(match, ' ', '')[1:4])[k])::hugeint),
    lambda rest, c: case when c >= 65 then (rest * 100 + c - 55) % 97 else (rest * 10 + c - 48) % 97 end,
    0::hugeint) = 1"""


def _pii() -> str:
    parts, kept = [], []
    for order, (kind, (pattern, check)) in enumerate(_PLAIN.items()):
        parts.append(_PLACED.format(kind=kind, pattern=pattern, order=order))
        kept.append(f"select * from {kind}_placed where {check.replace('{mod97}', _MOD97)}")
    spans = "kind || ':' || start || ':' || (start + len(match))"
    counts = ", ".join(f"count(*) filter (kind = '{kind}') as n_{kind}" for kind in list(_PLAIN)[:4])
    return f"""with texts as (select doc_id, coalesce(text, '') as text from documents),
{", ".join(parts)}, spans as ({" union all ".join(kept)})
select doc_id, {counts},
       sha256(coalesce(string_agg({spans}, ',' order by start, ord) filter (ord < 4), '')) as base_sha256,
       coalesce(string_agg({spans}, ',' order by start, ord), '') as spans, count(kind) as n_spans
from documents left join spans using (doc_id) group by doc_id"""


PII = _pii()


def quality_rules_sql() -> str:
    """Statistics from SQL of their own; the estimation steps as nested selects over the operator's formulas."""
    q, starts = quality_rules, range(len(quality_rules.STARTS))
    ctes = [
        r"""worded as (
    select doc_id, to_json({'lang': lang, 'source': source})::varchar as grp,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, coalesce(text, '') as text from documents
)""",
        f"""windows as (
    select doc_id, pos, array_to_string(w[pos:pos + {q.WINDOW - 1}], ' ') as run
    from (select doc_id, w, unnest(range(1, len(w) - {q.WINDOW - 2})) as pos from worded where len(w) > {q.WINDOW})
), again as (
    select doc_id, pos from windows join (select doc_id, run from windows group by all having count(*) > 1)
    using (doc_id, run)
), repeated as (
    select doc_id, count(distinct pos + k) as n_repeat_words
    from again, (select unnest(range(0, {q.WINDOW})) as k) group by doc_id
)""",
        rf"""base as (
    select doc_id, grp, len(w)::bigint as n_words, len(array_to_string(w, ''))::bigint as word_chars,
           len(regexp_extract_all(text, '{q.SYMBOLS}'))::bigint as n_symbols,
           (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(
            list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           ))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from worded left join repeated using (doc_id)
)""",
        "rows_0 as materialized (select *, "
        + ", ".join(f"cast(round(1000 * {q.VECTOR[a][0]}) as bigint) as {a}" for a in q.AXES)
        + " from base)",
        "medians as (select grp, "
        + ", ".join(f"quantile_disc({a}, 0.5) as q_{a}" for a in q.AXES)
        + " from rows_0 group by grp)",
        "at_0 as (select rows_0.*, "
        + ", ".join(f"{q.start_distance(k)} as d{k}" for k in starts)
        + " from rows_0 join medians using (grp))",
    ]
    for step in range(q.STEPS + 1):
        sums = ", ".join(
            f"{e.replace('decimal(38,0)', 'hugeint')} as {c}" for k in starts for c, e in q.sums(k).items()
        )
        limits = ", ".join(f"quantile_disc(d{k}, {q.CORE}) as core{k}" for k in starts)
        ctes.append(f"limits_{step} as materialized (select grp, {limits} from at_{step} group by grp)")
        core = f"at_{step} join limits_{step} using (grp)"
        ctes.append(f"sums_{step} as materialized (select grp, {sums} from {core} group by grp)")
        levels = [level for k in starts for level in (q.estimate_columns(k), *q.factor_columns(k))]
        ctes.append(f"est_{step} as materialized ({_nested(f'sums_{step}', levels)})")
        solved = _nested(
            f"(select * from rows_0 join est_{step} using (grp))", [x for k in starts for x in q.solve_columns(k)]
        )
        own = ["doc_id", "grp", *q.AXES, *(f"d{k}" for k in starts)]
        ctes.append(f"at_{step + 1} as materialized (select {', '.join(own)} from ({solved}))")
    names = ", ".join(f"{e} as {c}" for c, e in q.chosen_columns().items())
    ctes.append(f"chosen as materialized (select grp, {names} from est_{q.STEPS})")
    ctes.append(f"last as ({_nested('(select * from rows_0 join chosen using (grp))', q.solve_columns(''))})")
    return "with " + ",\n".join(ctes) + f"""
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({q.BASE_FAILED}) as base_failed,
       not ({q.BASE_FAILED}) and d2 <= {q.CUTOFF} as kept from last"""


def _nested(source: str, levels: list[dict[str, str]]) -> str:
    for level in levels:
        source = f"(select *, {', '.join(f'{e} as {c}' for c, e in level.items())} from {source})"
    return f"select * from {source}"
