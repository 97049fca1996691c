"""License notices in documents, by MinHash bands over overlapping windows.

A document's two-word shingles are hashed and cut into windows that overlap by nearly half. For each of
``BANDS`` hash orders the smallest shingle of a window is its band value; the orders are made by xor with a
seed. Notices are cut in the same way at every offset. Equal band values retrieve a notice. A band value is a
shingle of its window, so windows without a shingle of any notice have none that is equal and are left out. A notice of up
to five words lies in one window whole and has a Jaccard similarity of at least 4/7 with it, so with eight
bands of one row it is missed with probability (3/7)^8, about 1 in 900; longer notices meet several windows.

A retrieved notice counts only if at least ``MIN_CONTAINED_PERCENT`` of its shingles stand close together in the
text, which is checked exactly, and if none of those is lacking that tells its license or version from others.
Everything is built-in expressions; the notices are a few hundred
literals, and documents are not moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm.tables import text_or_empty

#: fixed values: public license notices
NOTICES: dict[str, str] = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "lgpl": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "mpl-1.1-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    ),
    "epl-1.0": "made available under the terms of the Eclipse Public License v1.0",
    "epl-2.0": "made available under the terms of the Eclipse Public License v2.0",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "cc-by-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
} | {
    f"cc-{code}-{version}-sentence": f"This work is licensed under a Creative Commons Attribution-{words} {version} {place} License."
    for version, place in (("3.0", "Unported"), ("4.0", "International"))
    for code, words in (
        ("by-sa", "ShareAlike"),
        ("by-nc", "NonCommercial"),
        ("by-nd", "NoDerivatives"),
        ("by-nc-sa", "NonCommercial-ShareAlike"),
        ("by-nc-nd", "NonCommercial-NoDerivatives"),
    )
} | {
    f"cc-{code}-{version}": f"Licensed under CC {code.upper()} {version}."
    for code in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
    for version in ("3.0", "4.0")
    if code != "by" and (code, version) not in (("by-nc", "4.0"), ("by-sa", "4.0"))
} | {f"cc-by-{version}-short": f"Licensed under CC BY {version}." for version in ("3.0", "4.0")}

#: words that tell licenses of one wording apart; numbers do as well
VARIANT_WORDS = {
    "lesser", "library", "affero", "noncommercial", "sharealike", "noderivatives", "noderivs", "nc", "sa", "nd",
}

BANDS = 8
#: shingles of a window, and from one window to the next
WINDOW = 7
STEP = 4
MIN_CONTAINED_PERCENT = 80
#: seeds of the orders: multiples of the golden ratio's bits, as signed 64-bit integers
_SEEDS = [((k * 0x9E3779B97F4A7C15) + (1 << 63)) % (1 << 64) - (1 << 63) for k in range(1, BANDS + 1)]
_TAG = BANDS - 1


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pairs(found: Column) -> Column:
    """Hashes of adjacent words."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.zip_with(F.slice(found, 1, n), F.slice(found, 2, n), lambda a, b: F.xxhash64(a, b))


def telling(found: Column) -> Column:
    """Hashes of the adjacent words that a text must have: numbers and variant words with their neighbours, and what follows GNU."""
    n = F.greatest(F.size(found) - 1, F.lit(0))

    def hashed(a: Column, b: Column) -> Column:
        number = b.rlike("^v?[0-9]+$") & (a != "v")
        return F.when(number | a.isin(*VARIANT_WORDS) | b.isin(*VARIANT_WORDS) | (a == "gnu"), F.xxhash64(a, b))

    return F.filter(F.zip_with(F.slice(found, 1, n), F.slice(found, 2, n), hashed), lambda x: x.isNotNull())


def every_offset(hashes: str) -> Column:
    """The windows at every shingle, by the place of their first shingle, from 1."""
    size = F.size(F.col(hashes))
    return F.when(size > 0, F.sequence(F.lit(1), F.greatest(size, F.lit(1)))).otherwise(F.array().cast("array<int>"))


def places_of(hashes: str, known: list[int]) -> Column:
    """The places, from 0, of the ``known`` shingles."""
    listed = [F.lit(v).cast("bigint") for v in known]
    return F.filter(F.transform(F.col(hashes), lambda x, i: F.when(x.isin(*listed), i)), lambda i: i.isNotNull())


def windows_over(places: str) -> Column:
    """Of the windows at every ``STEP`` shingles those that hold one of the ``places``, as in ``every_offset``."""

    def around(i: Column) -> Column:
        first = F.greatest(F.floor((i - (WINDOW - STEP)) / STEP).cast("int"), F.lit(0))
        return F.transform(F.sequence(first, F.floor(i / STEP).cast("int")), lambda m: m * STEP + 1)

    return F.array_distinct(F.flatten(F.transform(F.col(places), around)))


def band_values(hashes: str, starts: str) -> Column:
    """The band values of the windows that begin at ``starts``, with the band's number in the lowest bits.

    Both name columns; an expression would be computed per window.
    """

    def band(k: int) -> Column:
        def least(i: Column) -> Column:
            ordered = F.transform(F.slice(F.col(hashes), i, WINDOW), lambda x: x.bitwiseXOR(F.lit(_SEEDS[k])))
            return F.array_min(ordered).bitwiseAND(F.lit(~_TAG)).bitwiseOR(F.lit(k))

        return F.transform(F.col(starts), least)

    return F.concat(*[band(k) for k in range(BANDS)])


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, however often it is used later."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def notices(spark: SparkSession, texts: dict[str, str]) -> list[tuple[str, list[int], list[int], list[int]]]:
    """Name, shingles, telling shingles and band values of every notice; as many rows as notices."""
    table = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(v).alias("text")) for k, v in texts.items()])).alias("n"))
    table = table.select("n.name", F.array_distinct(pairs(words(F.col("n.text")))).alias("hashes"), telling(words(F.col("n.text"))).alias("telling"), pairs(words(F.col("n.text"))).alias("all"))
    table = _once(table, "_starts", every_offset("all"))
    rows = table.select("name", "hashes", "telling", F.array_distinct(band_values("all", "_starts")).alias("bands")).collect()
    return [(r.name, r.hashes, r.telling, r.bands) for r in rows]


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", texts: dict[str, str] | None = None) -> DataFrame:
    """For every row its id, ``licenses`` (names of the notices found, sorted, joined by commas) and ``n_licenses``.

    Null and empty texts have none. Repeated rows are scanned each for itself, an empty table gives no
    rows, and other columns are not read.
    """
    known = notices(docs.sparkSession, texts or NOTICES)

    def longs(values) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")

    rows = docs.select(F.col(f"`{id_column}`"), text_or_empty(text_column).alias("_text"))
    rows = _once(rows, "_words", words(F.col("_text"))).drop("_text")
    rows = _once(rows, "_hashes", pairs(F.col("_words"))).drop("_words")
    # A band value is a shingle of its window, so a window without a notice's shingle agrees with none.
    rows = _once(rows, "_places", places_of("_hashes", sorted({h for _, hashes, *_ in known for h in hashes})))
    rows = _once(rows, "_starts", windows_over("_places"))
    rows = _once(rows, "_bands", band_values("_hashes", "_starts")).drop("_starts")
    rows = _once(rows, "_shared", F.transform("_places", lambda i: F.get("_hashes", i))).drop("_places")

    def found(name: str, hashes: list[int], must: list[int], bands: list[int]) -> Column:
        wanted, need, n = longs(hashes), -(-MIN_CONTAINED_PERCENT * len(hashes) // 100), len(hashes)
        starts = F.sequence(F.lit(1), F.greatest(F.size("_hashes"), F.lit(1)), F.lit(n))
        # Any run of n shingles lies in one of these stretches of 2 n.
        def close(i: Column) -> Column:
            stretch = F.slice("_hashes", i, 2 * n)
            enough = F.size(F.array_intersect(stretch, wanted)) >= need
            return enough & (F.size(F.array_except(longs(must), stretch)) == 0) if must else enough

        contained = F.exists(starts, close)
        retrieved = F.arrays_overlap("_bands", longs(bands))
        # A stretch has no more of the notice than the whole text.
        possible = F.size(F.array_intersect(F.col("_shared"), wanted)) >= need
        return F.when(F.when(retrieved, F.when(possible, contained).otherwise(F.lit(False))).otherwise(F.lit(False)), F.lit(name))

    every = longs(sorted({v for *_, bands in known for v in bands}))
    names = F.when(F.arrays_overlap("_bands", every), F.array(*[found(*notice) for notice in known]))
    kept = F.array_sort(F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda x: x.isNotNull()))
    return _once(rows, "_names", kept).select(
        id_column, F.array_join("_names", ",").alias("licenses"), F.size("_names").cast("long").alias("n_licenses")
    )
