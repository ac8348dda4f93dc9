"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from deskwise.llm import licences as lic
from deskwise.llm import repetition as rep

WORDS = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licences() -> str:
    """Texts and known licences brought to one form and compared as texts, then hashed."""
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in lic.KNOWN_LICENCES)
    spellings = ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in lic.EQUIVALENT_SPELLINGS.items())

    def canonical(column: str) -> str:
        folded = (
            f"trim(regexp_replace(regexp_replace(lower({column}), {_quoted(lic.COPYRIGHT_LINE)}, ' ', 'g'), "
            f"{_quoted(lic.NOT_WORDS)}, ' ', 'g'))"
        )
        return (
            f"array_to_string(list_transform(string_split({folded}, ' '), "
            f"lambda w: coalesce(map {{{spellings}}}[w], w)), ' ')"
        )

    return f"""
    with texts as (
        select doc_id, cast(null as integer) as line, text from documents
        union all
        select doc_id, cast(i as integer), string_split(text, chr(10))[i]
        from (select doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) as i from documents)
    ),
    known as (
        select {canonical("t")} as form, min(name) as licence from (values {known}) as k(name, t) group by 1
    ),
    forms as (select doc_id, line, {canonical("text")} as form from texts)
    select doc_id, line, licence, sha256(form) as digest from forms join known using (form) where form <> ''
    """


def repetition() -> str:
    """n-grams as texts, counted by grouping; coverage by sliding over the windows that recur."""
    top, covered = rep.MOST_IN_TOP_NGRAM, rep.MOST_IN_REPEATED_NGRAMS
    lengths = [*top, *covered]
    grams = ",\n".join(
        f"""grams_{n} as (
            select doc_id, pos, gram, chars, count(*) over (partition by doc_id, gram) as n from (
                select doc_id, pos, n_words, string_agg(w, ' ') over s as gram, sum(length(w)) over s as chars
                from words window s as (partition by doc_id order by pos rows between current row and {n - 1} following)
            ) where pos + {n - 1} <= n_words)"""
        for n in lengths
    )
    tops = ",\n".join(
        f"""top_{n} as (
            select doc_id, max(n * chars) as chars from
                (select *, max(n) over (partition by doc_id) as most from grams_{n})
            where n = most and n > 1 group by 1)"""
        for n in top
    )
    covers = ",\n".join(
        f"""cover_{n} as (
            select doc_id, sum(length(w)) as chars, count(*) as words from (
                select w.doc_id, w.w, max(case when g.n > 1 then 1 else 0 end)
                    over (partition by w.doc_id order by w.pos rows between {n - 1} preceding and current row) as hit
                from words w left join grams_{n} g using (doc_id, pos)
            ) where hit = 1 group by 1)"""
        for n in [3, *covered]
    )
    columns = [f"coalesce(top_{n}.chars, 0)::bigint as top_{n}_chars" for n in top]
    columns += [f"coalesce(cover_{n}.chars, 0)::bigint as repeated_{n}_chars" for n in covered]
    joins = "\n".join(
        [f"left join top_{n} using (doc_id)" for n in top] + [f"left join cover_{n} using (doc_id)" for n in [3, *covered]]
    )
    limits = [f"100 * top_{n}_chars <= {k} * word_chars" for n, k in top.items()]
    limits += [f"100 * repeated_{n}_chars <= {k} * word_chars" for n, k in covered.items()]
    limits += [
        f"100 * dup_line_chars <= {rep.MOST_LINE_CHARS} * word_chars",
        f"100 * n_dup_lines <= {rep.MOST_LINES} * n_lines",
    ]
    return rf"""
    with docs as (select doc_id, coalesce(text, '') as text from documents),
    split as (select doc_id, regexp_extract_all(text, '{WORDS}') as ws from docs),
    words as (
        select doc_id, len(ws) as n_words, unnest(ws) as w, unnest(generate_series(1, len(ws))) as pos from split
    ),
    lines as (
        select doc_id, line, i, array_to_string(regexp_extract_all(line, '{WORDS}'), '') as own from (
            select doc_id, unnest(string_split(text, chr(10))) as line,
                unnest(generate_series(1, len(string_split(text, chr(10))))) as i from docs)
    ),
    by_line as (
        select doc_id, count(*) as n_lines, count(*) filter (nth > 1) as n_dup_lines,
            sum(case when nth > 1 then length(own) else 0 end) as dup_line_chars
        from (select doc_id, own, row_number() over (partition by doc_id, line order by i) as nth from lines where own <> '')
        group by 1
    ),
    {grams},
    {tops},
    {covers},
    measured as (
        select s.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
            coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
            coalesce(dup_line_chars, 0)::bigint as dup_line_chars,
            coalesce(cover_3.words, 0)::bigint as n_repeat_words,
            {", ".join(columns)}
        from split s join docs using (doc_id) left join by_line using (doc_id) {joins}
    )
    select *, (n_words < {rep.MIN_WORDS} or 100 * n_repeat_words > {rep.MOST_REPEAT_WORDS} * n_words) as base_failed,
        not (n_words < {rep.MIN_WORDS} or 100 * n_repeat_words > {rep.MOST_REPEAT_WORDS} * n_words)
            and {" and ".join(limits)} as kept
    from measured
    """


def archives() -> str:
    """SHA-1 from hexadecimal to base32: five hexadecimal digits are four of base32."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = " || ".join(
        f"'{digits}'[(('0x' || sha[{5 * k + 1}:{5 * k + 5}])::bigint >> {shift} & 31) + 1]"
        for k in range(8)
        for shift in (15, 10, 5, 0)
    )
    return f"""
    with payloads as (
        select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as sha from pages
    ),
    firsts as (select *, min(page_id) over (partition by payload) as first from payloads)
    select page_id, strlen(payload)::bigint as payload_bytes, {letters} as payload_digest,
        case when page_id = first then 'response' else 'revisit' end as record_type,
        case when page_id = first then null else first end as refers_to
    from firsts
    """


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _crc_table() -> str:
    """One row: the list of the 256 remainders of CRC-32."""
    steps = "select b, b as c from (select unnest(range(256)) as b)"
    for _ in range(8):
        steps = f"select b, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end as c from ({steps})"
    return f"select list(c order by b) as remainders from ({steps})"


def _crc(text: str) -> str:
    """Of a text of ASCII and characters up to U+07FF, beside a row of the table."""
    byte = "case when unicode(c) < 128 then [unicode(c)] else [192 + unicode(c) // 64, 128 + unicode(c) % 64] end"
    listed = f"list_transform(string_split({text}, ''), lambda c: cast({byte} as bigint[]))"
    step = "xor(a // 256, remainders[xor(a % 256, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, flatten({listed})), lambda a, b: {step}), 4294967295)"


def manifest(levels: int = 6) -> str:
    """Levels written out, up to 16 to the power of ``levels`` leaves; proofs by walking up from the leaf."""

    def tree(name: str, first: str) -> str:
        """Nodes and siblings by level, from numbered nodes to the last one of each tree."""
        parts = [f"{name}_0 as ({first})"]
        for k in range(levels):
            parts.append(f"""{name}_{k + 1} as (
                select tree, i // 16 as i, sha256(string_agg(digest, '' order by i)) as digest,
                  (any_value(n) + 15) // 16 as n from {name}_{k} where n > 1 group by tree, i // 16)""")
            parts.append(f"""{name}_run_{k} as (
                select tree, i,
                  coalesce(string_agg(digest, '') over (run rows between unbounded preceding and 1 preceding), '') as before,
                  coalesce(string_agg(digest, '') over (run rows between 1 following and unbounded following), '') as after
                from {name}_{k} where n > 1 window run as (partition by tree, i // 16 order by i))""")
        ends = " union all ".join(f"select tree, digest from {name}_{k} where n = 1" for k in range(levels + 1))
        return ", ".join([*parts, f"{name}_end as ({ends})"])

    def walk(name: str, place: str, tree_of: str, start: str) -> str:
        parts = [f"{name}_walk_0 as ({start})"]
        for k in range(levels):
            parts.append(f"""{name}_walk_{k + 1} as (
                select w.* exclude (node, proof),
                  case when r.i is null then node else sha256(r.before || node || r.after) end as node,
                  proof || coalesce(r.before || r.after, '') as proof
                from {name}_walk_{k} w left join {name}_run_{k} r
                  on r.tree = {tree_of} and r.i = {place} // {16**k})""")
        return ", ".join(parts)

    def record(text: str) -> str:
        fields = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
        each = [f"case when {f} is null then '-' else strlen({f}) || ':' || {f} end" for f in fields]
        return f"sha256({' || '.join(each)})"

    return f"""
    with crc_table as ({_crc_table()}),
    leaves as (
        select doc_id, coalesce('v' || source, '') as tree, {record("text")} as leaf,
          case when {_crc("doc_id::varchar")} % 5 = 0 then {record(f"translate(text, '{UPPER}', '{LOWER}')")} end as changed
        from documents, crc_table
    ),
    placed as (
        select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place,
          count(*) over (partition by tree) as n
        from leaves
    ),
    {tree("leaf", "select tree, place as i, leaf as digest, n from placed")},
    sources as (
        select tree, digest, row_number() over (order by tree) - 1 as source_place, count(*) over () as n from leaf_end
    ),
    {tree("top", "select '' as tree, source_place as i, digest, n from sources")},
    {walk("leaf", "w.place", "w.tree", "select *, coalesce(changed, leaf) as node, '' as proof from placed")},
    {walk("top", "w.source_place", "''",
          f"select w.*, s.digest as subroot, s.source_place from leaf_walk_{levels} w join sources s using (tree)")}
    select doc_id, leaf, subroot, (select digest from top_end) as root, sha256(proof) as proof_sha256,
      node as folded_root, node = (select digest from top_end) as verified
    from top_walk_{levels}
    """


def spelling_variants() -> str:
    """Words one edit apart share what is left when a code point is taken out of one or both."""
    lowered = f"translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{UPPER}', '{LOWER}')"
    return f"""
    with recursive crc_table as ({_crc_table()}),
    runs as (
        select doc_id, run, count(*) as times from (select doc_id, {lowered} as run from documents)
        where length(run) >= 6 group by all
    ),
    hashed as (select *, {_crc("coalesce(doc_id::varchar, '') || ':' || run")} as h from runs, crc_table),
    words as (
        select word, cast(sum(times) as bigint) as n from (
            select times, case when h % 199 = 0
              then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
            from hashed)
        where length(word) >= 6 group by word having sum(times) >= 5
    ),
    shorter as (
        select word, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) as rest
        from (select word, cast(unnest(range(1, length(word) + 1)) as integer) as pos from words)
    ),
    pairs as (
        select a.word as a, b.word as b from shorter a join shorter b on a.rest = b.rest and a.pos = b.pos where a.word <> b.word
        union select s.word, w.word from shorter s join words w on w.word = s.rest
        union select w.word, s.word from shorter s join words w on w.word = s.rest
    ),
    ranked as (
        select a, b, w.n, row_number() over (partition by a order by w.n desc, b) as place, count(*) over (partition by a) as near
        from pairs join words w on w.word = b
    ),
    formed as (
        select words.word, words.n, coalesce(near, 0) as n_near,
          case when ranked.n >= 5 * words.n then b end as form, case when ranked.n >= 5 * words.n then ranked.n end as form_n
        from words left join ranked on a = words.word and place = 1
    ),
    chain as (
        select word, word as reached from formed
        union all select chain.word, formed.form from chain join formed on formed.word = chain.reached where formed.form is not null
    ),
    roots as (select chain.word, chain.reached as root from chain join formed on formed.word = chain.reached where formed.form is null)
    select word, form, root, n, n_near, form_n from formed join roots using (word)
    """
