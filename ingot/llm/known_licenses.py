"""Known licence texts and one-line notices (fixed values: public licence wording)."""

from pathlib import Path

MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so"""
MIT_NOTICE = """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
MIT_AS_IS = """

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC_AS_IS = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_THIRD = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
BSD_AS_IS = """

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

TEXTS = [
    ("MIT", MIT_GRANT + MIT_NOTICE + MIT_AS_IS),
    ("MIT-0", MIT_GRANT + "." + MIT_AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\n"
     "purpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies." + ISC_AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any\n"
     "purpose with or without fee is hereby granted." + ISC_AS_IS),
    ("BSD-2-Clause", BSD_HEAD + BSD_AS_IS),
    ("BSD-3-Clause", BSD_HEAD + BSD_THIRD + BSD_AS_IS),
    ("Zlib", ZLIB),
    ("Apache-2.0", APACHE_NOTICE),
]

NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]

# Names under which a short text is titled; the longer licences hold their titles.
TITLES = {
    "MIT": ["MIT"], "MIT-0": ["MIT No Attribution"], "ISC": ["ISC"], "0BSD": ["BSD Zero Clause"],
    "BSD-2-Clause": ["BSD 2-Clause", "Simplified BSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "New BSD", "Modified BSD"], "Zlib": ["zlib"],
}

# Whole licences that Linux systems carry: name, file.
SYSTEM_FOLDER = "/usr/share/common-licenses"
SYSTEM_FILES = [
    ("Apache-2.0", "Apache-2.0"), ("Artistic-1.0", "Artistic"), ("CC0-1.0", "CC0-1.0"),
    ("GFDL-1.2", "GFDL-1.2"), ("GFDL-1.3", "GFDL-1.3"), ("GPL-1.0", "GPL-1"), ("GPL-2.0", "GPL-2"),
    ("GPL-3.0", "GPL-3"), ("LGPL-2.0", "LGPL-2"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"),
    ("MPL-1.1", "MPL-1.1"), ("MPL-2.0", "MPL-2.0"),
]


def titled(texts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The texts, also under each usual form of their titles."""
    out = list(texts)
    for name, text in texts:
        for title in TITLES.get(name, []):
            out += [(name, f"{head}\n\n{text}") for head in (
                f"{title} License", f"The {title} License", f"{title} License ({title})",
                f"The {title} License ({title})", f"{title} License ({name})",
                f"The {title} License ({name})")]
    return out


def system_texts(folder: str = SYSTEM_FOLDER) -> list[tuple[str, str]]:
    """Whole licences from a folder on the driver; those that are not there are left out."""
    found = ((name, Path(folder, file)) for name, file in SYSTEM_FILES)
    return [(name, path.read_text(errors="replace")) for name, path in found if path.is_file()]
