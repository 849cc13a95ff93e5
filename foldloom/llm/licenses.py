"""Licence scans by sentence rules: sentences are normalised and mapped to known identifiers, and ordered sequences of
identifiers are matched against rules. Built-in expressions only; every row is judged alone, without a shuffle.

A text is cut into sentences at line ends and after ``. ; : ! ?`` before white space, once as it is and once with its single line ends taken as
spaces, so that hard-wrapped licence texts are recognised too. Normalising lowers, keeps letters, digits and inner dots, and joins the rest to one
space. A rule matches when its identifiers occur in its order, with any sentences between them. Texts that are null or empty have
no sentences and no licence. Repeated rows and ids are judged one by one; columns beside id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of well-known licences and notices, with their identifiers.
SENTENCES = {
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind": "mit-disclaimer",
    "licensed under the apache license version 2.0": "apache-name",
    "licensed under the apache license version 2.0 the license": "apache-grant",
    "you may not use this file except in compliance with the license": "apache-condition",
    "you may obtain a copy of the license at": "apache-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-name",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-terms",
    "licensed under cc by nc 4.0": "cc-by-nc-name",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "cc-by-nc-full",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "all rights reserved": "reserved",
}

# Licences by ordered sequences of identifiers.
RULES = [
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-title", "mit-grant"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("Apache-2.0", ["apache-name"]),
    ("Apache-2.0", ["apache-grant", "apache-condition"]),
    ("GPL-3.0", ["gpl3-name"]),
    ("GPL-3.0", ["gpl-free", "gpl3-terms"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-full"]),
    ("BSD", ["bsd-grant", "bsd-source"]),
    ("Proprietary", ["reserved"]),
]

CUT = "[\n\r]+|[.;:!?]+[ \t\n\r]+"
WRAP = "([^\n\r])\r?\n([^\n\r])"


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9.]+", " "), F.lit(" ."))


def identifiers(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order."""
    known = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))
    found = F.transform(F.split(text, CUT), lambda s: F.try_element_at(known, normalised(s)))
    return F.filter(found, lambda x: x.isNotNull())


def pattern(sequence: list[str]) -> str:
    return " " + " (?:.* )?".join(sequence) + " "


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sentence_ids, licenses`` for every row, both joined by spaces; licences in alphabetical order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col),
        F.array_join(identifiers(text), " ").alias("as_is"),
        F.array_join(identifiers(F.regexp_replace(text, WRAP, "$1 $2")), " ").alias("unwrapped"),
    )
    both = F.concat(F.lit(" "), F.col("as_is"), F.lit(" \n "), F.col("unwrapped"), F.lit(" "))
    names = sorted({name for name, _ in RULES})
    hits = [F.when(both.rlike("|".join(pattern(s) for n, s in RULES if n == name)), F.lit(name)) for name in names]
    return rows.select(F.col(id_col), F.col("as_is").alias("sentence_ids"), F.concat_ws(" ", *hits).alias("licenses"))


def oracle(id_col: str = "doc_id") -> str:
    """The same in SQL over ``documents``."""
    text = "coalesce(text, '')"
    unwrapped = f"regexp_replace({text}, '{_sql(WRAP)}', '\\1 \\2', 'g')"
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items()) + "}"

    def ids(source):
        parts = f"string_split_regex({source}, '{_sql(CUT)}')"
        name = "trim(regexp_replace(lower(s), '[^a-z0-9.]+', ' ', 'g'), ' .')"
        return f"coalesce(array_to_string(list_filter(list_transform({parts}, lambda s: known[{name}]), lambda x: x IS NOT NULL), ' '), '')"

    names = sorted({name for name, _ in RULES})
    hits = ", ".join(
        f"CASE WHEN regexp_matches(both_, '{'|'.join(pattern(s) for n, s in RULES if n == name)}') THEN '{name}' END" for name in names
    )
    return f"""
    WITH k AS (SELECT {known} AS known),
    f AS (SELECT {id_col}, {ids(text)} AS as_is, {ids(unwrapped)} AS unwrapped FROM documents, k),
    b AS (SELECT *, ' ' || as_is || ' ' || chr(10) || ' ' || unwrapped || ' ' AS both_ FROM f)
    SELECT {id_col}, as_is AS sentence_ids, concat_ws(' ', {hits}) AS licenses FROM b"""


def _sql(regex: str) -> str:
    return regex.replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t").replace("'", "''")
