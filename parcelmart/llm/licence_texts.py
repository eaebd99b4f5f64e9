"""Public licence texts, as published, and one-line licence notices."""

from functools import reduce
from pathlib import Path

# Entire texts by their usual short names; copyright lines are left out, as they vary.
LICENCE_TEXTS = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the public at
large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.""",
}

# Titles that usually stand above these texts.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "BSD Zero Clause License (0BSD)", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD", "0BSD License"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License",
        "The Simplified BSD License", "The 2-Clause BSD License", "BSD License", "The BSD License", "FreeBSD License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License",
        "The New BSD License", "Modified BSD License", "Revised BSD License", "The 3-Clause BSD License", "BSD License", "The BSD License",
    ],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC", "Internet Systems Consortium license"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "Expat License", "MIT License (Expat)"],
    "Unlicense": ["The Unlicense", "Unlicense", "UNLICENSE (public domain)"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib License (Zlib)"],
}

# Passages that published copies of a text word in two ways.
WORDINGS = {
    "BSD-2-Clause": [[("1. ", "* "), ("2. ", "* ")]],
    "BSD-3-Clause": [[("1. ", "* "), ("2. ", "* "), ("3. ", "* ")], [("1. ", "(1) "), ("2. ", "(2) "), ("3. ", "(3) ")]],
    "ISC": [[("and/or distribute", "and distribute")]],
    "MIT": [[("permission notice shall", "permission notice (including the next paragraph) shall")]],
    "Unlicense": [[("For more information, please refer to <https://unlicense.org>", "")]],
}

# Entire texts as published, one file each, named by their usual short names.
LICENCE_FILES = Path(__file__).with_name("licences")

# First lines of published texts that copies may lack.
TITLE_LINES = ["Boost Software License", "Creative Commons Legal Code"]

# Lines after which published texts may end.
LAST_LINES = ["END OF TERMS AND CONDITIONS"]


def published_texts() -> list[tuple[str, str]]:
    """(name, text) of the known licences: those above, in every wording with and without a title; and
    the files, whole, without their first line and without the appendix on how to apply them."""
    rows = []
    for name, text in LICENCE_TEXTS.items():
        bodies = [text]
        for changes in WORDINGS.get(name, []):
            bodies.append(reduce(lambda body, change: body.replace(*change), changes, text))
        rows += [(name, f"{title}\n\n{body}") for body in bodies for title in ["", *TITLES.get(name, [])]]
    for file in sorted(LICENCE_FILES.glob("*.txt")):
        text = file.read_text("utf-8").strip()
        rows.append((file.stem, text))
        rows += [(file.stem, text.partition("\n")[2]) for first in TITLE_LINES if text.startswith(first)]
        rows += [(file.stem, text[: text.index(last) + len(last)]) for last in LAST_LINES if last in text]
    return rows


# Notices that stand as a line of their own, and the licence each names.
NOTICES = {
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under the MIT License.": "MIT",
    "Released into the public domain.": "public domain",
    "Released under the BSD License.": "BSD",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}

# More notices of the same kind.
MORE_NOTICES = {
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "Licensed under CC BY 3.0.": "CC-BY-3.0",
    "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
    "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "Licensed under CC BY-SA 3.0.": "CC-BY-SA-3.0",
    "Licensed under the Apache License 2.0.": "Apache-2.0",
    "Licensed under the BSD 2-Clause License.": "BSD-2-Clause",
    "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
    "Licensed under the BSD License.": "BSD",
    "Licensed under the Eclipse Public License 2.0.": "EPL-2.0",
    "Licensed under the ISC License.": "ISC",
    "Licensed under the Mozilla Public License 2.0.": "MPL-2.0",
    "Licensed under the Mozilla Public License, Version 2.0.": "MPL-2.0",
    "Licensed under the zlib License.": "Zlib",
    "Released under CC0 1.0.": "CC0-1.0",
    "Released under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the ISC License.": "ISC",
    "Released under the Unlicense.": "Unlicense",
    "This work is dedicated to the public domain.": "public domain",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "This work is licensed under the GNU Free Documentation License, version 1.3.": "GFDL-1.3",
    "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
}

# Spellings that count as equal; the left one (a regular expression on lower-case text
# without punctuation) becomes the right one.
SPELLINGS = {
    r"\b(licen|offen)ces?\b": r"\1se",
    r"\b(sub) (licen)": r"\1\2",
    r"\b(acknowledg|judg)ement": r"\1ment",
    r"\b(anal|catal)ogue": r"\1og",
    r"\b(anal)yse": r"\1yze",
    r"\bartefact": "artifact",
    r"\b(authori|capitali|categori|emphasi|initiali|maximi|optimi|organi|reali|recogni|utili)s(e|i|a)": r"\1z\2",
    r"\b(calib|cent)re\b": r"\1er",
    r"\b(cancel|label|model|signal)l(ed|ing)\b": r"\1\2",
    r"\b(fav|lab)our": r"\1or",
    r"\bfulfill?(ment)?\b": r"fulfil\1",
    r"\bnon (commercial)": r"non\1",
    r"\bcopyright owner": "copyright holder",
    r"\bpractis": "practic",
    r"\bprogramme\b": "program",
    r"\bwhilst\b": "while",
    r"\bwil(l?)ful": "wilful",
    r"\bper cent\b": "percent",
    r"\bhttps?\b": "http",
}
