"""Known licences."""

from pathlib import Path

# Published licence texts without their copyright lines, and notices of a line or a paragraph.
LICENCES = [
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT-notice", "Released under the MIT License."),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
]

_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = _BSD_2 + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
for _name, _text in (("BSD-2-Clause", _BSD_2 + _BSD_END), ("BSD-3-Clause", _BSD_3 + _BSD_END)):
    LICENCES += [(_name, _text), (_name, _text.replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("\n3. ", "\n* "))]
LICENCES += [
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", dict(LICENCES)["ISC"].replace("and/or distribute", "and distribute")),
]
# Longer texts as their publishers give them.
LICENCES += [(_path.name.removesuffix(".txt"), _path.read_text(encoding="utf-8")) for _path in sorted((Path(__file__).parent / "texts").glob("*.txt"))]

_TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
}
LICENCES += [(_name, f"{_title}\n\n{_text}") for _name, _text in list(LICENCES) for _title in _TITLES.get(_name, [])]

# The notices that the publishers give to put in a file: a first paragraph, and the whole.
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"""
_APACHE_END = """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
for _scheme in ("http", "https"):
    _url = f"{_scheme}://www.apache.org/licenses/LICENSE-2.0"
    LICENCES += [("Apache-2.0-notice", f"{_APACHE} {_url}"), ("Apache-2.0-notice", f"{_APACHE} {_url} {_APACHE_END}")]
LICENCES += [("Apache-2.0-notice", _APACHE)]
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"
LICENCES += [("MPL-2.0-notice", f"{_MPL} {_scheme}://mozilla.org/MPL/2.0/.") for _scheme in ("http", "https")]
_GNU = [
    ("GPL-1.0", "General Public License", "1", "program"), ("GPL-2.0", "General Public License", "2", "program"), ("GPL-3.0", "General Public License", "3", "program"),
    ("LGPL-2.0", "Library General Public License", "2", "library"), ("LGPL-2.1", "Lesser General Public License", "2.1", "library"),
    ("LGPL-3.0", "Lesser General Public License", "3", "library"), ("AGPL-3.0", "Affero General Public License", "3", "program"),
]
for _name, _title, _version, _what in _GNU:
    for _it in {_what, "program"}:
        for _colon in (":", ";"):
            _start = f"This {_it} is free software{_colon} you can redistribute it and/or modify it under the terms of the GNU {_title} as published by the Free Software Foundation"
            LICENCES += [(f"{_name}-notice", f"{_start}{_either} version {_version} of the License, or (at your option) any later version.") for _either in (", either", "; either")]
LICENCES += [
    (f"{_name}-notice", f"SPDX-License-Identifier: {_id}")
    for _name in sorted({n for n, _ in LICENCES if not n.endswith("-notice")} | {"AGPL-3.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "EPL-2.0"})
    for _id in ([_name, f"{_name}-only", f"{_name}-or-later", f"{_name}+"] if "GPL" in _name or "GFDL" in _name else [_name])
]
