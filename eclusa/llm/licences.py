"""Licence scans by sentence rules.

A text is cut into sentences in two ways. By lines: each line end ends a sentence, as for a
notice of one line among lines of other text. Joined: lines of a paragraph are one run of text,
whose sentences end at punctuation, as for notices that are wrapped; comment signs at the
lines' starts are no words, and a line without words ends the paragraph. Each sentence is
normalised (lower case, words with one space between) and looked up in the table of known licence
sentences. The identifiers found, in order, are matched against ordered licence rules: a
rule is a sequence of sentence identifiers, the first rule that fits at the leftmost place
wins, and its sentences are used up. Sentences of one rule must follow each other directly;
numbers of list items don't count between them. A licence counts if it is found either way.

Only DataFrame functions are used; every row is handled by itself, so nothing is
shuffled, and a very long text is scanned whole in its row. A null or empty text has no
sentences and no licences. Repeated rows are each returned, in no order. Unknown sentences match
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences by which licences are granted or named, normalised.
SENTENCES = {
    "this work is licensed under the gnu general public license version 3": "gpl3-work",
    "this program is licensed under the gnu general public license version 3": "gpl3-work",
    "licensed under cc by nc 4 0": "ccbync4-name",
    "licensed under cc by 4 0": "ccby4-name",
    "licensed under cc by sa 4 0": "ccbysa4-name",
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    "licensed under the apache license version 2 0": "apache2-name",
    "licensed under the apache license version 2 0 the license": "apache2-head",
    "you may not use this file except in compliance with the license": "apache2-use",
    "you may obtain a copy of the license at": "apache2-copy",
    "all rights reserved": "rights-reserved",
    "redistribution and use in source and binary forms with or without modification"
    " are permitted provided that the following conditions are met": "bsd-conditions",
    "this program is free software": "gpl-free",
    "this program is distributed in the hope that it will be useful": "gpl-hope",
    "the above copyright notice and this permission notice shall be included in all"
    " copies or substantial portions of the software": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction"
    " including without limitation the rights to use copy modify merge publish distribute sublicense"
    " and or sell copies of the software and to permit persons to whom the software is furnished to"
    " do so subject to the following conditions": "mit-grant",
    "the software is provided as is without warranty of any kind express or implied including but not"
    " limited to the warranties of merchantability fitness for a particular purpose and"
    " noninfringement": "mit-as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee"
    " is hereby granted provided that the above copyright notice and this permission notice appear in"
    " all copies": "isc-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and"
    " the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions"
    " and the following disclaimer in the documentation and or other materials provided with the"
    " distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
    " or promote products derived from this software without specific prior written"
    " permission": "bsd-name",
    "unless required by applicable law or agreed to in writing software distributed under the license is"
    " distributed on an as is basis without warranties or conditions of any kind either express or"
    " implied": "apache2-as-is",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-form",
    "this library is free software": "gpl-free",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "you can redistribute it and or modify it under the terms of the gnu general public license as"
    " published by the free software foundation either version 3 of the license or at your option any"
    " later version": "gpl3-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as"
    " published by the free software foundation either version 2 of the license or at your option any"
    " later version": "gpl2-later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
    " published by the free software foundation either version 2 1 of the license or at your option any"
    " later version": "lgpl21-later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
    " published by the free software foundation either version 3 of the license or at your option any"
    " later version": "lgpl3-later",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as"
    " published by the free software foundation either version 3 of the license or at your option any"
    " later version": "agpl3-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as"
    " published by the free software foundation": "gpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
    " published by the free software foundation": "lgpl-terms",
    "either version 2 of the license or at your option any later version": "v2-later",
    "either version 2 1 of the license or at your option any later version": "v21-later",
    "either version 3 of the license or at your option any later version": "v3-later",
    "spdx license identifier mit": "spdx-mit",
    "spdx license identifier apache 2 0": "spdx-apache2",
    "spdx license identifier gpl 3 0 only": "spdx-gpl3",
}
# Rules in the order in which they are tried, longer before shorter.
RULES = (
    ("Apache-2.0", ("apache2-head", "apache2-use", "apache2-copy")),
    ("Apache-2.0", ("apache2-head", "apache2-use")),
    ("Apache-2.0", ("apache2-as-is",)),
    ("GPL-3.0", ("gpl3-work", "gpl-free")),
    ("GPL-3.0", ("gpl-free", "gpl3-later", "gpl-hope")),
    ("GPL-3.0", ("gpl-free", "gpl3-later")),
    ("GPL-2.0", ("gpl-free", "gpl2-later", "gpl-hope")),
    ("GPL-2.0", ("gpl-free", "gpl2-later")),
    ("GPL-2.0", ("gpl-free", "gpl-terms", "v2-later")),
    ("GPL-3.0", ("gpl-free", "gpl-terms", "v3-later")),
    ("LGPL-2.1", ("gpl-free", "lgpl-terms", "v21-later")),
    ("LGPL-3.0", ("gpl-free", "lgpl-terms", "v3-later")),
    ("LGPL-2.1", ("gpl-free", "lgpl21-later", "gpl-hope")),
    ("LGPL-2.1", ("gpl-free", "lgpl21-later")),
    ("LGPL-3.0", ("gpl-free", "lgpl3-later", "gpl-hope")),
    ("LGPL-3.0", ("gpl-free", "lgpl3-later")),
    ("AGPL-3.0", ("gpl-free", "agpl3-later", "gpl-hope")),
    ("AGPL-3.0", ("gpl-free", "agpl3-later")),
    ("GPL", ("gpl-free", "gpl-hope")),
    ("BSD-3-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-conditions", "bsd-source", "bsd-binary")),
    ("BSD", ("rights-reserved", "bsd-conditions")),
    ("BSD", ("bsd-conditions",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-form",)),
    ("MIT", ("mit-name", "mit-notice")),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("apache2-head",)),
    ("Apache-2.0", ("apache2-name",)),
    ("Apache-2.0", ("spdx-apache2",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0", ("spdx-gpl3",)),
    ("CC-BY-NC-4.0", ("ccbync4-name",)),
    ("CC-BY-4.0", ("ccby4-name",)),
    ("CC-BY-SA-4.0", ("ccbysa4-name",)),
)

# By lines, a sentence ends at a line's end, or behind . ! ? or ; with white space after it.
ENDS = r"([.!?;])[\x20\t\r]+"
# Joined, at a line without words, or behind . ! ? ; or : with white space or a line end after it.
NO_WORDS = r"\n(?:[^0-9A-Za-z\n]*\n)+"
JOINED_ENDS = r"([.!?;:])[\x20\t\r\n]+"
MARK = "\x01"
NOT_WORDS = r"[^0-9A-Za-z]+"


def sentences(text: Column) -> Column:
    """Sentences of a text's lines as they stand; one of only white space counts as well."""
    return F.split(F.regexp_replace(text, ENDS, "$1\n"), "\n")


def joined_sentences(text: Column) -> Column:
    """Sentences of a text's paragraphs that have a letter, with the lines' ends in them."""
    marked = F.regexp_replace(F.regexp_replace(text, NO_WORDS, MARK), JOINED_ENDS, "$1" + MARK)
    return F.filter(F.split(marked, MARK), lambda s: s.rlike("[A-Za-z]"))


def normalised(sentence: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(sentence, NOT_WORDS, " ")))


def _known(known: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in known.items() for x in pair))


def rule_pattern(rules=RULES) -> str:
    """All rules in their order, as alternatives over runs of ``<id>``."""
    return "|".join(
        "(?:" + "".join(f"<{sentence}>" for sentence in sequence) + ")" for _, sequence in rules
    )


def _identified(cut: Column, known: dict[str, str]) -> Column:
    """Number and identifier of each known sentence."""
    numbered = F.filter(
        F.transform(cut, lambda s, i: F.struct(i.alias("at"), s.alias("s"))), lambda x: F.length(x.s) > 0
    )
    return F.filter(
        F.transform(
            numbered,
            lambda x: F.struct(
                x.at.alias("at"), F.try_element_at(_known(known), normalised(x.s)).alias("id")
            ),
        ),
        lambda x: x.id.isNotNull(),
    )


def _matches(ids: str, rules) -> Column:
    """Licences of the rules that fit the identifiers, in order."""
    # Runs of directly following sentences; "|" parts them, so that no rule spans a gap.
    run = F.aggregate(
        ids,
        F.struct(F.lit(-2).alias("at"), F.lit("").alias("s")),
        lambda acc, x: F.struct(
            x["at"].alias("at"),
            F.concat(
                acc["s"],
                F.when(x["at"] == acc["at"] + 1, "").otherwise("|"),
                F.lit("<"),
                x["id"],
                F.lit(">"),
            ).alias("s"),
        ),
        lambda acc: acc["s"],
    )
    names = F.create_map(
        *(F.lit(x) for name, seq in rules for x in ("".join(f"<{s}>" for s in seq), name))
    )
    return F.transform(
        F.regexp_extract_all(run, F.lit(rule_pattern(rules)), F.lit(0)),
        lambda m: F.element_at(names, m),
    )


def _listed(ids: str) -> Column:
    return F.concat_ws(
        ",", F.transform(ids, lambda x: F.concat(x["at"].cast("string"), F.lit(":"), x["id"]))
    )


def scan(
    documents: DataFrame,
    text: str = "text",
    known: dict[str, str] = SENTENCES,
    rules=RULES,
) -> DataFrame:
    """Each document row with its ``doc_id``, number of sentences, known ones and licences.

    ``n_sentences`` are those of the lines. ``sentence_ids`` and ``joined_ids``:
    ``number:identifier`` of each known sentence of the lines, and of the paragraphs, in order.
    ``licences``: of each rule that matched the lines, in order, and then of those that matched
    the paragraphs, if the lines have no such licence; one of the lines is left out if the
    paragraphs know its version (BSD and BSD-3-Clause). ``licence``: the distinct ones.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    found = documents.select(
        "doc_id",
        F.when(whole == "", 0).otherwise(F.size(sentences(whole))).alias("n_sentences"),
        _identified(sentences(whole), known).alias("ids"),
        _identified(joined_sentences(whole), known).alias("joined"),
    )
    listed = found.withColumns({"by_lines": _matches("ids", rules), "by_paragraphs": _matches("joined", rules)})
    more = F.filter("by_paragraphs", lambda m: ~F.array_contains("by_lines", m))
    vague = lambda m: F.exists("by_paragraphs", lambda p: F.startswith(p, F.concat(m, F.lit("-"))))
    both = F.concat(F.filter("by_lines", lambda m: ~vague(m)), more)
    return listed.select(
        "doc_id",
        F.col("n_sentences").cast("long").alias("n_sentences"),
        _listed("ids").alias("sentence_ids"),
        _listed("joined").alias("joined_ids"),
        F.concat_ws(",", both).alias("licences"),
        F.concat_ws(",", F.array_sort(F.array_distinct(both))).alias("licence"),
    )


def oracle() -> str:
    """The same over ``documents`` in DuckDB's SQL."""
    known = ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items())
    names = ", ".join(
        "'" + "".join(f"<{s}>" for s in seq) + f"': '{name}'" for name, seq in RULES
    )

    def view(name: str, cut: str) -> str:
        return f"""
    {name}_each as (
      select r, unnest(s) as x, generate_subscripts(s, 1) - 1 as pos from (select r, {cut} as s from rows_)),
    {name}_known as (
      select r, pos, element_at(map {{{known}}}, trim(lower(regexp_replace(x, '[^0-9A-Za-z]+', ' ', 'g'))))[1] as id
      from {name}_each),
    {name}_ids as (
      select r, pos, id, lag(pos) over (partition by r order by pos) as was from {name}_known where id is not null),
    {name}_runs as (
      select r, string_agg(pos || ':' || id, ',' order by pos) as ids,
        string_agg(case when was = pos - 1 then '' else '|' end || '<' || id || '>', '' order by pos) as run
      from {name}_ids group by r),
    {name} as (
      select r, ids,
        list_transform(regexp_extract_all(run, '{rule_pattern()}'), lambda m: element_at(map {{{names}}}, m)[1]) as matches
      from {name}_runs)"""

    by_lines = "string_split(regexp_replace(t, '([.!?;])[\\x20\\t\\r]+', '\\1\n', 'g'), chr(10))"
    marked = "regexp_replace(t, '\\n(?:[^0-9A-Za-z\\n]*\\n)+', chr(1), 'g')"
    marked = f"regexp_replace({marked}, '([.!?;:])[\\x20\\t\\r\\n]+', '\\1' || chr(1), 'g')"
    paragraphs = f"list_filter(string_split({marked}, chr(1)), lambda x: regexp_matches(x, '[A-Za-z]'))"
    return f"""
    with rows_ as (
      select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
    {view("lines", by_lines)},
    {view("paragraphs", paragraphs)},
    both_ as (
      select r, doc_id, case when t = '' then 0 else len({by_lines}) end as n_sentences,
        coalesce(l.ids, '') as sentence_ids, coalesce(p.ids, '') as joined_ids,
        list_filter(coalesce(l.matches, []),
          lambda m: len(list_filter(coalesce(p.matches, []), lambda x: starts_with(x, m || '-'))) = 0) || list_filter(coalesce(p.matches, []),
          lambda m: not list_contains(coalesce(l.matches, []), m)) as matches
      from rows_ left join lines l using (r) left join paragraphs p using (r))
    select doc_id, n_sentences, sentence_ids, joined_ids, array_to_string(matches, ',') as licences,
      array_to_string(list_sort(list_distinct(matches)), ',') as licence
    from both_
    """
