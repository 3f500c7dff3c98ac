"""Licence scans by sentence rules. DataFrame functions only.

A text is cut into sentences; each is normalised and mapped to the identifier of a known licence sentence. The
identifiers of a text, in order, are then matched against ordered licence rules: a rule that finds its sequence takes
those identifiers away, and later rules see what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as they stand in the licences' own texts and usual notices, normalised (see `normalised`):
# identifier and pattern of the whole sentence. Fixed values.
SENTENCES = (
    ("mitGrant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files .*"),
    ("mitNotice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("asIs", r"the software is provided as is without warranty of any kind .*"),
    ("apacheComply", r"you may not use this file except in compliance with the license"),
    ("apacheCopy", r"you may obtain a copy of the license at .*"),
    ("apacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis .*"),
    ("gplFree", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2Free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gplHope", r"this program is distributed in the hope that it will be useful but without any warranty .*"),
    ("bsdGrant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met .*"),
    ("bsdEndorse", r"neither the name of .* may be used to endorse or promote products derived from this software .*"),
    ("iscGrant", r"permission to use copy modify and ?or distribute this software for any purpose with or without fee is hereby granted .*"),
    ("iscAsIs", r"the software is provided as is and the author disclaims all warranties .*"),
    ("unlicenseGrant", r"anyone is free to copy modify publish use compile sell or distribute this software .*"),
    ("publicDomain", r"(?:.*\b(?:is|are|been|hereby) )?(?:free and unencumbered software )?(?:released|placed|dedicated|put)(?: \w+){0,3}? (?:in|into|to) the public domain\b.*"),
    ("copyright", r"(?:copyright|\(c\)|©).*"),
    ("unknownLicence", r".*\b(?:licen[cs]e[ds]?|all rights reserved)\b.*"),
)
_LATER = r"(?: of the licen[cs]e)?,?(?: or later| or (?:at your option )?(?:any )?later)"


def _gnu(words: str, short: str, version: str, later: bool) -> str:
    number = rf",?(?: as published by the free software foundation)?,?(?: either)?,? ?(?:version |v\.? ?)?{version}(?![.\d]*\d)"
    return rf"(?:(?:gnu )?{words}general public licen[cs]e(?: {short})?|(?:gnu )?{short}){number}" + (_LATER if later else rf"(?!{_LATER})")


def _cc(kind: str, short: str, version: str) -> str:
    return rf"(?:cc {short}|creative commons {kind})(?: licen[cs]e)?,? (?:version |v)?{version}"


# Names of licences, normalised: identifier of a sentence that names one, name of the licence, pattern. Fixed values.
NAMED = (
    ("mitNamed", "MIT", r"mit(?: x11| expat)?"),
    ("apacheNamed", "Apache-2.0", r"(?:the )?apache(?: software)?(?: licen[cs]e)?,? ?(?:version |v\.? ?)?2(?:\.0)?(?![.\d]*\d)"),
    *((f"{i}{v[0]}{'Later' * later}Named", f"{n}-{v}-or-later" if later else f"{n}-{v}", _gnu(w, i, v.replace(".0", "(?:\\.0)?"), later))
      for i, n, w, versions in (("gpl", "GPL", "", ("3.0", "2.0")), ("lgpl", "LGPL", "(?:lesser |library )", ("3.0", "2.1", "2.0")), ("agpl", "AGPL", "affero ", ("3.0",)))
      for v in versions for later in (True, False)),
    ("mpl2Named", "MPL-2.0", r"(?:mozilla public licen[cs]e|mpl),? ?(?:version |v\.? ?)?2(?:\.0)?(?![.\d]*\d)"),
    ("ccByNc4Named", "CC-BY-NC-4.0", _cc("attribution non ?commercial", "by nc", r"4\.0")),
    ("ccBySa4Named", "CC-BY-SA-4.0", _cc("attribution share ?alike", "by sa", r"4\.0")),
    ("ccBySa3Named", "CC-BY-SA-3.0", _cc("attribution share ?alike", "by sa", r"3\.0")),
    ("ccBy4Named", "CC-BY-4.0", _cc("attribution", "by", r"4\.0")),
    ("cc0Named", "CC0-1.0", r"(?:creative commons )?(?:cc0|cc zero)(?:,? ?(?:v|version )?1\.0)?"),
    ("bsd3Named", "BSD-3-Clause", r"(?:bsd 3 clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)"),
    ("bsd2Named", "BSD-2-Clause", r"(?:bsd 2 clause|(?:2|two) clause bsd|(?:simplified|freebsd) bsd)"),
    ("iscNamed", "ISC", r"isc"),
    ("unlicenseNamed", "Unlicense", r"unlicense"),
)
#: A name counts behind a word of licensing and then "under", behind an SPDX tag, or as a sentence of its own. What follows the
#: first of these is found in one pass each, so a sentence that repeats them a thousand times is read as fast as any other.
_LICENSING = r"(?<!not )\b(?:licen[cs]ed|released|distributed|redistributed|available|published|provided|offered|covered|modify it)\b(.*)$"
_UNDER = r"\bunder (.*)$"
_TAG = r"(?:^| )spdx licen[cs]e identifier (.*)$"
# Licence rules in the order in which they are tried: name and sequence of sentence identifiers. Fixed values.
RULES = (
    ("MIT", ("mitGrant", "mitNotice", "asIs")),
    ("MIT", ("mitGrant", "mitNotice")),
    ("Apache-2.0", ("apacheNamed", "apacheComply", "apacheCopy", "apacheAsIs")),
    ("Apache-2.0", ("apacheNamed", "apacheComply", "apacheCopy")),
    ("GPL-3.0-or-later", ("gplFree", "gplHope")),
    ("GPL-3.0-or-later", ("gplFree",)),
    ("GPL-2.0-or-later", ("gpl2Free", "gplHope")),
    ("GPL-2.0-or-later", ("gpl2Free",)),
    ("BSD-3-Clause", ("bsdGrant", "bsdEndorse")),
    ("BSD-2-Clause", ("bsdGrant",)),
    ("ISC", ("iscGrant", "iscAsIs")),
    ("ISC", ("iscGrant",)),
    ("Unlicense", ("unlicenseGrant",)),
    ("public-domain", ("publicDomain",)),
    *((name, (i,)) for i, name, _ in NAMED),
    ("unknown", ("unknownLicence",)),
)
#: A text in which this is not found has no known sentence.
HINT = r"(?i)licen[cs]e|copyright|\(c\)|©|warrant|redistribut|permission|all rights reserved|provided as is|copy of the|endorse|public\s+domain|free to copy|\bunder\b"
#: Sentence ends: a full stop, ! or ? before white space, or a line end unless the next line goes on, behind spaces and
#: comment signs, in lower case or with a bracket or goes on with a licence's name, or this line ends within one.
ENDS = (
    r"(?:[.!?](?=[\x20\x09-\x0D])|(?<!(?i:\b(?:the|a|an|under|of|gnu|lesser|library|affero|mozilla|apache|creative|commons|mit|bsd|isc|general|public|version|by|identifier:)|licen[cs]e,)[\x20\x09\r]{0,4})\n"
    r"(?![\x20\x09]*(?:[#*/;%!-]+[\x20\x09]*)?(?:[a-z(]|Licen[cs]e\b|Version [0-9]|General Public|Public Licen|Attribution)))"
)


def sentences(text: Column) -> Column:
    return F.split(text, ENDS, -1)


def normalised(sentence: Column) -> Column:
    """Lower case; comment signs, quotes, hyphens, slashes and other marks are spaces; one space between words; no full stop at the end."""
    later = F.regexp_replace(F.lower(sentence), r"(?<=[0-9])\+", " or later")
    plain = F.regexp_replace(later, r"[^\p{L}\p{N}.,()©]+|,(?!\s*version)|\((?!c\))|(?<!\(c)\)", " ")
    return F.btrim(F.regexp_replace(F.regexp_replace(plain, r"\s+", " "), r"[\s.,]+$", ""))


def sentence_ids(sentence: Column) -> Column:
    """Identifiers of a normalised sentence: the first pattern that fits all of it, or else all licences that it names, or
    else a copyright or unknown licence; empty if it has none."""

    def first(patterns: tuple) -> Column:
        found = F.array().cast("array<string>")
        for name, pattern in reversed(patterns):
            found = F.when(sentence.rlike(f"^(?:{pattern})$"), F.array(F.lit(name))).otherwise(found)
        return found

    def names(pattern: str, behind: Column) -> Column:
        return F.exists(behind, lambda x: x.rlike(rf"(?:^| )(?:{pattern})(?![\p{{L}}\p{{N}}])")) | sentence.rlike(rf"^(?:the )?(?:{pattern})(?: licen[cs]e)?$") & sentence.rlike("licen[cs]e")

    whole = first(SENTENCES[:-2])
    under = F.regexp_extract(F.regexp_extract(sentence, _LICENSING, 1), _UNDER, 1)
    # bound once for all names
    behind = F.array(F.array(under, F.regexp_extract(sentence, _TAG, 1)))
    named = F.flatten(F.transform(behind, lambda b: F.array_compact(F.array(*[F.when(names(pattern, b), F.lit(name)) for name, _, pattern in NAMED]))))
    return F.when(F.size(whole) > 0, whole).when(F.size(named) > 0, named).otherwise(first(SENTENCES[-2:]))


def _apply_rules(ids: Column) -> Column:
    """Names of the licences found. The text `<a><b>` of identifiers loses what a rule has found, so that it counts once."""
    state = F.struct(
        F.concat(F.lit(""), F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")).alias("left"),
        F.array().cast("array<string>").alias("names"),
    )
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("".join(f"<{i}>" for i in seq)).alias("seq")) for n, seq in RULES])

    def step(s: Column, r: Column) -> Column:
        hit = F.contains(s["left"], r["seq"])
        return F.when(hit, F.struct(F.replace(s["left"], r["seq"], F.lit("|")).alias("left"), F.array_union(s["names"], F.array(r["name"])).alias("names"))).otherwise(s)

    return F.aggregate(rules, state, step)["names"]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with sentence_ids (known sentences in order) and licenses (names in the order of the rules that found them).

    Null and empty texts have neither: two empty arrays. Rows are independent: nothing is shuffled, repeated rows
    each keep their row, extra columns stay, columns with the added names are replaced.
    """
    none = F.array().cast("array<string>")
    bare = docs.drop("sentence_ids", "licenses")
    ids = F.flatten(F.transform(F.filter(F.transform(sentences(F.col(text)), normalised), lambda x: x.rlike(SHORT_HINT)), sentence_ids))
    found = bare.withColumn("sentence_ids", F.when(F.col(text).rlike(HINT), ids).otherwise(none))
    return found.withColumn("licenses", F.when(F.size("sentence_ids") > 0, _apply_rules(F.col("sentence_ids"))).otherwise(none))


#: The same for one normalised sentence.
SHORT_HINT = r"licen[cs]e|copyright|\(c\)|©|warrant|redistribut|permission|all rights reserved|provided as is|copy of the|endorse|public\s+domain|free to copy|\bunder\b"
