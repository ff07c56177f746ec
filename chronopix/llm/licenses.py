"""Licence scan by canonical digest: whole texts, reduced to a canonical form, hash-joined to known licence digests."""

from __future__ import annotations

import hashlib
import re
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import arrow_map, only, texts

#: Spellings that count as one word.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "favour": "favor", "honour": "honor", "judgement": "judgment",
    "merchantibility": "merchantability", "organisation": "organization", "noninfringement": "noninfringement",
    "per cent": "percent", "whilst": "while", "wilful": "willful", "https": "http",
}
SPELLINGS = {k: v for k, v in SPELLINGS.items() if " " not in k and k != v}

_PUNCT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_COPYRIGHT = re.compile(rb"[\x20\t]*(?:copyright|\(c\)|\xc2\xa9|all rights reserved)[^\n]*", re.I)
#: A line that is a copyright statement, not one that merely begins with the word: a year, a sign or a placeholder follows.
_STATEMENT = re.compile(rb"[\x20\t]*(?:copyright[\x20\t:,]*(?:(?:\(c\)|\xc2\xa9)(?![\x20\t]*_)|[<\[{]|\d\d\d\d\b|\d\dyy\b)[^\n]*|(?:\(c\)|\xc2\xa9)[\x20\t]*(?:copyright\b|\d\d\d\d\b)[^\n]*|all rights reserved\.?[\x20\t]*$)", re.I)
_SPELL = {k.encode(): v.encode() for k, v in SPELLINGS.items()}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""


def _files() -> dict[str, str]:
    """Texts of the folder ``known``, and those with an appendix up to the end of their terms too."""
    end, out = "END OF TERMS AND CONDITIONS", {}
    for f in files("chronopix.llm").joinpath("known").iterdir():
        if f.name.endswith(".txt"):
            name, text = f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")
            out[name] = text
            if end in text:
                out[f"{name}-terms"] = text[: text.index(end) + len(end)]
    return out


#: Known licence texts and one-line notices, by identifier. A caller can give more.
KNOWN = {
    "MIT": "MIT License\n" + _MIT,
    "MIT-text": _MIT,
    "ISC": "ISC License\n" + _ISC,
    "ISC-text": _ISC,
    "BSD-2-Clause": "BSD 2-Clause License\n" + _BSD_2 + _BSD_END,
    "BSD-2-Clause-text": _BSD_2 + _BSD_END,
    "BSD-3-Clause": "BSD 3-Clause License\n" + _BSD_2 + _BSD_3 + _BSD_END,
    "BSD-3-Clause-text": _BSD_2 + _BSD_3 + _BSD_END,
    "Unlicense": _UNLICENSE + "\nFor more information, please refer to <https://unlicense.org>",
    "Unlicense-text": _UNLICENSE,
    "notice-Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "notice-GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "notice-CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "notice-MIT": "Released under the MIT License.",
} | _files()


def canonical(text: bytes, gone: re.Pattern[bytes] = _COPYRIGHT) -> bytes:
    """Lines that begin as copyright statements go, A-Z becomes lower case, other ASCII that is no letter or digit parts words, equivalent spellings become one; single spaces between words."""
    text = text.replace(b"\r", b"\n")
    kept = b"\n".join(x for x in text.split(b"\n") if not gone.match(x)) if _COPYRIGHT.search(text) else text
    return b" ".join([_SPELL.get(w, w) for w in kept.translate(_PUNCT).split()])


def _digests(text: bytes) -> tuple[str, str]:
    """The digest, and that of the text without copyright statements alone, which no wrapping of lines changes."""
    whole = hashlib.sha256(c := canonical(text)).hexdigest()
    flowing = canonical(text, _STATEMENT) if _COPYRIGHT.search(text) else c
    return whole, whole if flowing == c else hashlib.sha256(flowing).hexdigest()


def digest(text: str) -> str:
    return _digests(text.encode())[0]


def scan(documents: DataFrame, known: dict[str, str] | None = None, most: int = 100_000) -> DataFrame:
    """doc_id, digest, license_id of every row; license_id is null where the whole text is no known licence.

    Repeated rows and ids are rows of their own; whole texts count, however long; an empty table gives an empty one; columns but doc_id and text
    are not read. Null and empty texts, and texts of copyright lines and punctuation alone, have the digest of the empty text and no
    licence. A text that is none by its digest is looked up without its copyright statements
    alone, as a wrapped line may begin with the word. Two licences of one canonical form give the smaller identifier. The known digests are a stated table of at
    most ``most`` rows (else ValueError), so the hash join broadcasts them; documents are not shuffled.
    """
    known = KNOWN if known is None else known
    if len(known) > most:
        raise ValueError(f"{len(known)} known licences; at most {most}")
    by: tuple[dict[str, str], dict[str, str]] = ({}, {})
    for name in sorted(known, reverse=True):
        for d, at in zip(_digests(known[name].encode()), by, strict=True):
            at[d] = name
    for at in by:
        at.pop(digest(""), None)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [_digests(t) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in both], pa.string()) for i in (0, 1))], names=["doc_id", "digest", "flowing"])

    found = arrow_map(only(documents, doc_id="bigint", text="string"), one, "doc_id bigint, digest string, flowing string")
    spark = documents.sparkSession
    whole, flowing = spark.createDataFrame(sorted(by[0].items()), "digest string, a string"), spark.createDataFrame(sorted(by[1].items()), "flowing string, b string")
    found = found.join(F.broadcast(whole), "digest", "left").join(F.broadcast(flowing), "flowing", "left")
    return found.select("doc_id", "digest", F.coalesce("a", "b").alias("license_id"))


def sql(table: str = "documents") -> str:
    """The scan of the table in DuckDB's SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    spell = "w"
    for k, v in SPELLINGS.items():
        spell = f"CASE WHEN w = {q(k)} THEN {q(v)} ELSE {spell} END"
    known = ", ".join(f"({q(d)}, {q(n)})" for n, d in ((n, digest(t)) for n, t in KNOWN.items()))
    return f"""WITH lines AS (
  SELECT doc_id, list_filter(string_split(replace(coalesce(text, ''), chr(13), chr(10)), chr(10)), lambda x: NOT regexp_matches(x, '^[ \\t]*((?i)copyright|\\(c\\)|©|all rights reserved)')) AS kept
  FROM {table}), words AS (
  SELECT doc_id, regexp_extract_all(translate(array_to_string(kept, chr(10)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM lines), digests AS (
  SELECT doc_id, sha256(array_to_string(list_transform(ws, lambda w: {spell}), ' ')) AS digest FROM words),
known(digest, license_id) AS (SELECT d, min(n) FROM (VALUES {known}) v(d, n) GROUP BY d)
SELECT doc_id, digests.digest, license_id FROM digests LEFT JOIN known USING (digest)"""
