"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright lines left out, every run of other characters than ASCII
letters and digits one space, and equivalent spellings unified.  The SHA-256 of the whole canonical text is joined to
the digests of known licences, a table of fixed size; the same is done for each whole line, where licence notices stand.

Defined results: a null text is an empty one; a text or line whose canonical form is empty matches nothing; licence_id
is null where the whole text is no known licence; notices holds the sorted distinct ids of the lines that are known
texts; repeated rows are answered each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import text_of

COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|<|\[|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©|all rights reserved).*$"
OTHER = "[^a-z0-9]+"

# Equivalent spellings, as whole words of the canonical form.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"), ("licencor", "licensor"),
    ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"), ("acknowledgements", "acknowledgments"), ("authorised", "authorized"),
    ("authorisation", "authorization"), ("organisation", "organization"), ("organisations", "organizations"),
    ("recognised", "recognized"), ("favour", "favor"), ("judgement", "judgment"), ("fulfil", "fulfill"),
    ("per cent", "percent"), ("web site", "website"), ("e mail", "email"), ("ver 2", "version 2"), ("v 2", "version 2"), ("v2", "version 2"), ("v3", "version 3"),
]

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{keep}.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

# Licence texts and notices, by SPDX id.
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("BSD-2-Clause", _BSD.format(third="")), ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD.format(third="")),
    *(("BSD-3-Clause", title + _BSD.format(third="3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n")) for title in ("", "BSD 3-Clause License\n")),
    *(("ISC", title + _ISC.format(keep=", provided that the above copyright notice and this permission notice appear in all copies")) for title in ("", "ISC License\n")),
    *(("0BSD", title + _ISC.format(keep="")) for title in ("", "Zero-Clause BSD\n", "BSD Zero Clause License\n")),
    ("Apache-2.0", _APACHE),
    ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."), ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
    *((f"CC-{a}-{v}", f"{b} CC {a} {v}.") for a in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0") for b in ("Licensed under", "This work is licensed under")),
]


def canonical(text: Column) -> Column:
    """The canonical form, by DataFrame functions."""
    out = F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, " "), OTHER, " "), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def canonical_text(text: str) -> str:
    """The same in Python, for the table of digests."""
    out = f" {re.sub(OTHER, ' ', re.sub(COPYRIGHT, ' ', text.lower()))} "
    for old, new in SPELLINGS:
        out = out.replace(f" {old} ", f" {new} ")
    return re.sub(" +", " ", out).strip(" ")


def digests(known: list[tuple[str, str]] = KNOWN) -> list[tuple[str, str]]:
    """(digest, id) of the known texts."""
    return sorted({hashlib.sha256(canonical_text(t).encode()).hexdigest(): i for i, t in known if canonical_text(t)}.items())


HINTS = "licen[sc]|permission|redistribution"


def scan(docs: DataFrame, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """doc_id, license_id, notices and canonical_sha256 of every document."""
    pairs = digests(known)
    table = docs.sparkSession.createDataFrame(pairs, "digest string, id string")  # as many rows as known texts
    whole = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    listed = F.create_map(*[F.lit(x) for pair in pairs for x in pair]) if pairs else F.create_map().cast("map<string,string>")
    ids = F.transform(F.split("text", "\n"), lambda x: listed[F.sha2(canonical(x), 256)])
    notices = F.array_join(F.array_sort(F.array_distinct(F.filter(ids, lambda i: i.isNotNull()))), ",")
    if all(re.search(HINTS, canonical_text(t)) for _, t in known):  # then only texts with such a word can hold a known line
        notices = F.when(F.lower("text").rlike(HINTS), notices).otherwise("")
    shaped = whole.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"), notices.alias("notices"))
    return shaped.join(F.broadcast(table), F.col("canonical_sha256") == F.col("digest"), "left").select("doc_id", F.col("id").alias("license_id"), "notices", "canonical_sha256")


def oracle_sql() -> str:
    """The same in DuckDB's SQL."""
    form = f"concat(' ', regexp_replace(regexp_replace(lower(x), '{COPYRIGHT}', ' ', 'g'), '{OTHER}', ' ', 'g'), ' ')"
    for old, new in SPELLINGS:
        form = f"replace({form}, ' {old} ', ' {new} ')"
    values = ", ".join(f"('{d}', '{i}')" for d, i in digests())
    return f"""
        with known(digest, id) as (values {values}),
        d as (select row_number() over () n, doc_id, coalesce(text, '') text from documents),
        whole as (select n, doc_id, sha256(trim(regexp_replace({form.replace("lower(x)", "lower(text)")}, ' +', ' ', 'g'), ' ')) canonical_sha256 from d),
        lines as (select n, unnest(string_split(text, chr(10))) x from d where regexp_matches(lower(text), '{HINTS}')),
        notices as (
          select n, string_agg(distinct id, ',' order by id) notices
          from (select n, sha256(trim(regexp_replace({form}, ' +', ' ', 'g'), ' ')) digest from lines) join known using (digest) group by n
        )
        select doc_id, id license_id, coalesce(notices, '') notices, canonical_sha256
        from whole left join known on canonical_sha256 = digest left join notices using (n)"""
