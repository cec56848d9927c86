"""License scans by sentence rules (operator 9), DataFrame functions only.

A text is cut into sentences, each sentence is normalised (A-Z lower-cased,
everything but letters a-z and digits becomes one space) and mapped to the
identifiers of the known licence sentences and names that it holds as whole words,
from left to right; of two that begin at one word the longer counts, and words
already taken count no more. A sentence that speaks of a licence (``SPEAKS``) but
holds nothing known has the identifier ``unknown``. ``SPDX-License-Identifier`` tags are read
apart as expressions (AND, OR, WITH an exception, parentheses), each licence matched to
its end, and stand before the sentences. The sequence of identifiers is then matched
against ordered rules: a rule names a licence and the identifiers that must follow one
another; what it matches is taken out, so that a rule further down cannot claim it
again. What is left over is counted as unmatched, unknown licences among it.

Line breaks and comment signs inside a sentence do not matter (licences are
wrapped and stand in comments); a blank line, or one of comment signs alone, ends
a sentence. Only texts with one of ``TRIGGERS`` are cut at all: every
known sentence has one (a test holds this). One narrow pass, no shuffle.

Cases: null and empty texts give an empty sequence and no licence; repeated
rows give repeated results; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of common licences in normalised form.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied",
    "no-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability",
    "apache-2-use": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "apache-2-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "apache-2-governs": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-hope": "is distributed in the hope that it will be useful but without any warranty",
    "mpl-2-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "may be used to endorse or promote products derived from this software without specific prior written",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "isc-notice": "provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "cc0-dedication": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "all-rights": "all rights reserved",
}
# Names of licences as texts write them, with the kind of the licence.
NAMES = {
    "MIT": ("permissive", ["mit license"]),
    "Apache-2.0": ("permissive", ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"]),
    "MPL-2.0": ("copyleft", ["mozilla public license version 2 0", "mozilla public license 2 0"]),
    "EPL-2.0": ("copyleft", ["eclipse public license 2 0", "eclipse public license v 2 0"]),
    "BSD-2-Clause": ("permissive", ["bsd 2 clause license", "simplified bsd license"]),
    "BSD-3-Clause": ("permissive", ["bsd 3 clause license", "new bsd license"]),
    "ISC": ("permissive", ["isc license"]),
    "BSL-1.0": ("permissive", ["boost software license version 1 0"]),
    "CC0-1.0": ("permissive", ["cc0 1 0"]),
}
# The licences of one family, their versions and their words.
GNU = {"GPL": ("gnu general public license", ["2", "3"]), "LGPL": ("gnu lesser general public license", ["2.1", "3"]), "AGPL": ("gnu affero general public license", ["3"])}
COMMONS = {"by": ["attribution"], "nc": ["noncommercial", "non commercial"], "sa": ["sharealike", "share alike"], "nd": ["noderivatives", "no derivatives", "noderivs"]}
COMMONS_KINDS = {"by": "permissive", "by-sa": "copyleft", "by-nc": "restricted", "by-nd": "restricted", "by-nc-sa": "restricted", "by-nc-nd": "restricted"}
COMMONS_VERSIONS = ["2.0", "3.0", "4.0"]
# Identifiers of licence tags, without the ends that name later versions.
TAGS = {
    "mit": ("MIT", "permissive"), "mit-0": ("MIT-0", "permissive"), "0bsd": ("0BSD", "permissive"), "apache-2.0": ("Apache-2.0", "permissive"), "isc": ("ISC", "permissive"),
    "bsd-2-clause": ("BSD-2-Clause", "permissive"), "bsd-3-clause": ("BSD-3-Clause", "permissive"), "zlib": ("Zlib", "permissive"), "bsl-1.0": ("BSL-1.0", "permissive"),
    "unlicense": ("Unlicense", "permissive"), "cc0-1.0": ("CC0-1.0", "permissive"), "mpl-2.0": ("MPL-2.0", "copyleft"), "epl-2.0": ("EPL-2.0", "copyleft"), "eupl-1.2": ("EUPL-1.2", "copyleft"),
    "gpl-2.0": ("GPL-2.0", "copyleft"), "gpl-3.0": ("GPL-3.0", "copyleft"), "lgpl-2.1": ("LGPL-2.1", "copyleft"), "lgpl-3.0": ("LGPL-3.0", "copyleft"), "agpl-3.0": ("AGPL-3.0", "copyleft"),
    "busl-1.1": ("BUSL-1.1", "restricted"),
}


def _version(number: str) -> str:
    return number if "." in number else f"{number}.0"


def _spoken(text: str) -> str:
    return text.replace(".", " ")


def _table() -> tuple[dict[str, str], dict[str, tuple[str, str]], list[tuple[str, str, list[str]]]]:
    """All known words with their identifiers, all tags, and the ordered rules: longer sequences before what they hold."""
    words = {v: k for k, v in SENTENCES.items()}
    tags = dict(TAGS)
    long = [
        ("MIT", "permissive", ["mit-grant", "mit-notice", "as-is", "no-liability"]), ("MIT", "permissive", ["mit-grant", "mit-notice", "as-is"]), ("MIT", "permissive", ["mit-grant", "mit-notice"]),
        ("Apache-2.0", "permissive", ["name-Apache-2.0", "apache-2-use", "apache-2-copy", "apache-2-basis", "apache-2-governs"]),
        ("Apache-2.0", "permissive", ["name-Apache-2.0", "apache-2-use", "apache-2-copy", "apache-2-basis"]), ("Apache-2.0", "permissive", ["name-Apache-2.0", "apache-2-use"]),
        ("MPL-2.0", "copyleft", ["mpl-2-terms", "mpl-2-copy"]), ("MPL-2.0", "copyleft", ["mpl-2-terms"]),
        ("BSD-3-Clause", "permissive", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]), ("BSD-3-Clause", "permissive", ["bsd-redistribution", "bsd-endorse", "bsd-as-is"]),
        ("BSD-2-Clause", "permissive", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is"]), ("BSD-2-Clause", "permissive", ["bsd-redistribution", "bsd-as-is"]),
        ("ISC", "permissive", ["isc-grant", "isc-notice", "isc-as-is"]), ("ISC", "permissive", ["isc-grant", "isc-notice"]), ("ISC", "permissive", ["isc-grant"]),
        ("Unlicense", "permissive", ["unlicense-domain"]), ("CC0-1.0", "permissive", ["cc0-dedication"]), ("All-Rights-Reserved", "restricted", ["all-rights"]),
    ]
    short: list[tuple[str, str, list[str]]] = []

    def name(licence: str, kind: str, forms: list[str]) -> None:
        words.update({form: f"name-{licence}" for form in forms})
        short.append((licence, kind, [f"name-{licence}"]))

    for licence, (kind, forms) in NAMES.items():
        name(licence, kind, forms)
    for family, (full, versions) in GNU.items():
        low = family.lower()
        words |= {f"see the {full} for more details": f"{low}-see", f"you should have received a copy of the {full}": f"{low}-copy"}
        for v in versions:
            licence, said = f"{family}-{_version(v)}", _spoken(v)
            terms = f"{low}-{v}-terms"
            words[f"under the terms of the {full} as published by the free software foundation either version {said} of the license"] = terms
            words[f"under the terms of the {full} as published by the free software foundation version {said}"] = terms
            long += [(licence, "copyleft", [terms, *rest]) for rest in (["gpl-hope", f"{low}-see", f"{low}-copy"], ["gpl-hope", f"{low}-copy"], ["gpl-hope"], [])]
            name(licence, "copyleft", [f"{full} version {said}", f"{full} v {said}", f"{full} v{said}", f"{low} version {said}", f"{low}v{said}"])
    for parts, kind in COMMONS_KINDS.items():
        for v in COMMONS_VERSIONS:
            forms = [f"creative commons {' '.join(x)} {_spoken(v)}" for x in product(*[COMMONS[p] for p in parts.split("-")])]
            name(f"CC-{parts.upper()}-{v}", kind, [f"cc {_spoken(parts).replace('-', ' ')} {_spoken(v)}", *forms])
            tags[f"cc-{parts}-{v}"] = (f"CC-{parts.upper()}-{v}", kind)
    short += [(licence, kind, [f"spdx-{tag}"]) for tag, (licence, kind) in tags.items()]
    return words, tags, long + short


WORDS, ALL_TAGS, RULES = _table()
TRIGGERS = ["licen", "copyright", "warrant", "redistribut", "permission", "spdx", "rights", "creative commons", "public domain", "proprietary", "commercial use", "cc.by", "cc0", "gpl", "mpl", "endorse"]
# A sentence with one of these speaks of a licence.
SPEAKS = r"licen[sc]ed under|license agreement|license terms|under the terms of the .*license|public license|creative commons|permission (?:is|to) .*grant|(?:non ?)?commercial use|proprietary|into the public domain"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[ \t\n\r\f\x0B]"
COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/|//+|<!--+|--+>?|[*#;%]+|dnl\b|rem\b)[ \t]*"
SENTENCE_END = rf"[.!?;]+({SPACE}+|\z)|\n{SPACE}*\n"
TAG_LINE = r"spdx-license-identifier:[ \t]*([^\n\r]*)"
TAG = r"[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?"
TAG_EXPRESSION = rf"^ *({TAG}(?: (?:and|or|with) {TAG})*)"
LATER = r"(?:-only|-or-later|\+)$"


def _mark(identifier: str) -> str:
    return f"<{identifier}>"


def _tag_marks(lowered: Column) -> Column:
    """The marks of the licences in all tags of a text."""
    marks = F.create_map(*[F.lit(x) for tag in ALL_TAGS for x in (tag, _mark(f"spdx-{tag}"))])

    def of(line: Column) -> Column:
        flat = F.regexp_replace(F.regexp_replace(line, r"[()]", " "), " +", " ")
        expression = F.regexp_replace(F.regexp_extract(flat, TAG_EXPRESSION, 1), f" with {TAG}", "")
        tags = F.filter(F.regexp_extract_all(expression, F.lit(f"({TAG})"), F.lit(1)), lambda t: ~t.isin("and", "or"))
        return F.array_join(F.transform(tags, lambda t: F.coalesce(F.try_element_at(marks, F.regexp_replace(t, LATER, "")), F.lit(_mark("spdx-unknown")))), "")

    return F.array_join(F.transform(F.regexp_extract_all(lowered, F.lit(TAG_LINE), F.lit(1)), of), "")


def sentence_ids(text: Column) -> Column:
    """The marks of the tags and of the known sentences of a text, in order, as one string."""
    lowered = F.translate(text, UPPER, LOWER)
    known = sorted(WORDS.items(), key=lambda kv: (-len(kv[0]), kv[0]))
    found = F.lit(f"(?<= )({'|'.join(words for words, _ in known)})(?= )")
    marks = F.create_map(*[F.lit(x) for words, identifier in known for x in (words, _mark(identifier))])

    def mark(sentence: Column) -> Column:
        made = F.array_join(F.transform(F.regexp_extract_all(sentence, found, F.lit(1)), lambda words: marks[words]), "")
        return F.when((made == "") & F.rlike(sentence, F.lit(SPEAKS)), F.lit(_mark("unknown"))).otherwise(made)

    triggered = F.rlike(lowered, F.lit("|".join(TRIGGERS)))
    sentences = F.split(F.regexp_replace(F.regexp_replace(lowered, COMMENT, ""), SENTENCE_END, "\u0001"), "\u0001")
    normal = F.transform(sentences, lambda s: F.concat(F.lit(" "), F.regexp_replace(s, "[^a-z0-9]+", " "), F.lit(" ")))
    single = F.filter(F.transform(normal, lambda s: F.regexp_replace(s, " +", " ")), lambda s: F.rlike(s, F.lit("|".join(TRIGGERS))))
    return F.when(triggered, F.concat(_tag_marks(lowered), F.array_join(F.transform(single, mark), ""))).otherwise(F.lit(""))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sentences, licenses, kinds, n_licenses, n_unmatched`` per document.

    ``licenses`` names each licence once, in rule order, joined by commas.
    """
    rules = F.array(*[F.struct(F.lit("".join(map(_mark, ids))).alias("p"), F.lit(licence).alias("l"), F.lit(kind).alias("k")) for licence, kind, ids in RULES])
    start = F.struct(F.col("sentences").alias("rest"), F.array().cast("array<string>").alias("ls"), F.array().cast("array<string>").alias("ks"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["p"])
        more = lambda have, what: F.when(hit, F.array_union(have, F.array(what))).otherwise(have)
        return F.struct(F.replace(state["rest"], rule["p"], F.lit("|")).alias("rest"), more(state["ls"], rule["l"]).alias("ls"), more(state["ks"], rule["k"]).alias("ks"))

    out = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.coalesce(F.col(text_col), F.lit(""))).alias("sentences"))
    out = out.withColumn("end", F.when(F.col("sentences") == "", start).otherwise(F.aggregate(rules, start, apply)))
    return out.select(
        "doc_id", "sentences", F.array_join("end.ls", ",").alias("licenses"), F.array_join(F.array_sort("end.ks"), ",").alias("kinds"), F.size("end.ls").cast("long").alias("n_licenses"),
        F.length(F.regexp_replace("end.rest", "[^<]", "")).cast("long").alias("n_unmatched"),
    )


def oracle() -> str:
    """The same scan in DuckDB, by replacement: words stand in spaces of their own, the longest known words are replaced by
    their marks first, and the rules are folded over the sequence of marks."""
    known = sorted(WORDS.items(), key=lambda kv: (-len(kv[0]), kv[0]))
    apart = lambda w: " " + w.replace(" ", "  ") + " "
    phrases = ", ".join(f"{{'p': '{apart(w)}', 'm': ' {_mark(i)} '}}" for w, i in known)
    tags = ", ".join(f"'{t}'" for t in ALL_TAGS)
    rules = ", ".join(f"{{'p': '{''.join(map(_mark, ids))}', 'l': '{licence}', 'k': '{kind}'}}" for licence, kind, ids in RULES)
    trigger = "|".join(TRIGGERS)
    return f"""
WITH lowered AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') t FROM documents),
hit AS (SELECT doc_id, r, t, regexp_matches(t, '{trigger}') AS yes FROM lowered),
tagged AS (SELECT r, array_to_string(list_transform(flatten(list_transform(regexp_extract_all(t, '{TAG_LINE}', 1), lambda line:
      list_filter(regexp_extract_all(regexp_replace(regexp_extract(regexp_replace(regexp_replace(line, '[()]', ' ', 'g'), ' +', ' ', 'g'), '{TAG_EXPRESSION}', 1), ' with {TAG}', '', 'g'), '{TAG}'),
        lambda x: x <> 'and' AND x <> 'or'))),
    lambda x: CASE WHEN regexp_replace(x, '{LATER}', '') IN ({tags}) THEN '<spdx-' || regexp_replace(x, '{LATER}', '') || '>' ELSE '<spdx-unknown>' END), '') AS marks FROM hit WHERE yes),
cut AS (SELECT r, string_split(regexp_replace(regexp_replace(t, '{COMMENT}', '', 'g'), '{SENTENCE_END}', chr(1), 'g'), chr(1)) AS ss FROM hit WHERE yes),
normal AS (SELECT r, list_filter(list_transform(ss, lambda s: ' ' || trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) || ' '), lambda s: regexp_matches(s, '{trigger}')) AS ss FROM cut),
marked AS (SELECT r, list_transform(ss, lambda s: {{'s': s, 'm': array_to_string(regexp_extract_all(
    list_reduce([{phrases}], lambda a, b: {{'p': replace(a.p, b.p, b.m), 'm': ''}}, {{'p': ' ' || replace(trim(s), ' ', '  ') || ' ', 'm': ''}}).p, '<[^>]*>'), '')}}) AS ms FROM normal),
spoken AS (SELECT r, array_to_string(list_transform(ms, lambda x: CASE WHEN x.m = '' AND regexp_matches(x.s, '{SPEAKS}') THEN '<unknown>' ELSE x.m END), '') AS marks FROM marked),
whole AS (SELECT doc_id, coalesce(tagged.marks || spoken.marks, '') AS sentences FROM hit LEFT JOIN tagged USING (r) LEFT JOIN spoken USING (r)),
folded AS (SELECT doc_id, sentences, list_reduce([{rules}], lambda a, r: {{'p': replace(a.p, r.p, '|'), 'l': a.l || CASE WHEN contains(a.p, r.p) THEN ',' || r.l ELSE '' END,
    'k': a.k || CASE WHEN contains(a.p, r.p) THEN ',' || r.k ELSE '' END}}, {{'p': sentences, 'l': '', 'k': ''}}) f FROM whole),
named AS (SELECT doc_id, sentences, f.p AS p, list_filter(string_split(f.l, ','), lambda x: x <> '') ls, list_filter(string_split(f.k, ','), lambda x: x <> '') ks FROM folded),
once AS (SELECT *, list_filter(ls, lambda x, i: list_position(ls, x) = i) l1, list_sort(list_distinct(ks)) k1 FROM named)
SELECT doc_id, sentences, array_to_string(l1, ',') AS licenses, array_to_string(k1, ',') AS kinds, CAST(len(l1) AS BIGINT) AS n_licenses,
       CAST(length(regexp_replace(p, '[^<]', '', 'g')) AS BIGINT) AS n_unmatched
FROM once
"""
