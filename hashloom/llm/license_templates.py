"""What the license scan looks for: wording, names and identifiers of public licenses, with their labels.

A template is (label, deciding phrases, text). Text is matched word by word, as ``words_of``
cuts it; of each deciding phrase every pair of neighbouring words must stand in the scanned text.
"""

from __future__ import annotations

#: Phrases whose every place is reported, with their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Short notices.
NOTICES = (
    ("mit", ("mit license",), "released under the MIT license"),
    ("apache-2.0", ("apache license", "version 2"), "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", ("gnu general", "version 3"), "licensed under the GNU General Public License version 3"),
    ("gpl-2.0", ("gnu general", "version 2"), "licensed under the GNU General Public License version 2"),
    ("lgpl", ("lesser general",), "licensed under the GNU Lesser General Public License"),
    ("agpl", ("affero general",), "licensed under the GNU Affero General Public License"),
    ("mpl-2.0", ("mozilla public",), "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", ("attribution 4",), "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", ("attribution sharealike",), "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", ("attribution noncommercial 4",), "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", ("cc0 1",), "dedicated to the public domain under the CC0 1.0 Universal"),
    ("gpl-3.0", ("gnu general", "either version 3"), "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", ("gnu general", "either version 2"), "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl", ("gnu lesser",), "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl", ("gnu affero",), "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)

#: Names of licenses.
NAMES = (
    ("mit", ("mit license",), "MIT License"),
    ("mit", ("mit licence",), "MIT Licence"),
    ("apache-2.0", ("apache license version 2",), "Apache License, Version 2.0"),
    ("apache-2.0", ("apache license 2",), "Apache License 2.0"),
    ("gpl-3.0", ("gnu general", "license version 3"), "GNU General Public License version 3"),
    ("gpl-2.0", ("gnu general", "license version 2"), "GNU General Public License version 2"),
    ("gpl-3.0", ("license v3",), "GNU General Public License v3"),
    ("gpl-2.0", ("license v2",), "GNU General Public License v2"),
    ("lgpl", ("lesser general",), "GNU Lesser General Public License"),
    ("agpl", ("affero general",), "GNU Affero General Public License"),
    ("mpl-2.0", ("mozilla public license", "license version 2"), "Mozilla Public License, version 2.0"),
    ("mpl-2.0", ("mozilla public license 2",), "Mozilla Public License 2.0"),
    ("gpl-3.0", ("under gplv3",), "under GPLv3"),
    ("gpl-2.0", ("under gplv2",), "under GPLv2"),
    ("gpl-3.0", ("gplv3 license",), "GPLv3 license"),
    ("gpl-2.0", ("gplv2 license",), "GPLv2 license"),
    ("unlicense", ("the unlicense",), "the Unlicense"),
    ("bsd-3-clause", ("3 clause",), "BSD 3-Clause License"),
    ("bsd-2-clause", ("2 clause",), "BSD 2-Clause License"),
    ("isc", ("isc license",), "ISC License"),
    ("bsl-1.0", ("boost software license",), "Boost Software License, Version 1.0"),
    ("cc-by", ("attribution 4",), "Creative Commons Attribution 4.0 International"),
    ("cc-by-sa", ("attribution sharealike",), "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("cc-by-nc", ("attribution noncommercial 4",), "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("cc0", ("cc0 1",), "CC0 1.0 Universal"),
)

#: Identifiers after the words SPDX-License-Identifier, with their labels.
SPDX = (
    ("MIT", "mit"),
    ("Apache-2.0", "apache-2.0"),
    ("GPL-2.0", "gpl-2.0"),
    ("GPL-3.0", "gpl-3.0"),
    ("LGPL-2.1", "lgpl"),
    ("LGPL-3.0", "lgpl"),
    ("AGPL-3.0", "agpl"),
    ("BSD-2-Clause", "bsd-2-clause"),
    ("BSD-3-Clause", "bsd-3-clause"),
    ("MPL-2.0", "mpl-2.0"),
    ("ISC", "isc"),
    ("Zlib", "zlib"),
    ("BSL-1.0", "bsl-1.0"),
    ("Unlicense", "unlicense"),
    ("EPL-2.0", "epl-2.0"),
    ("CC0-1.0", "cc0"),
    ("CC-BY-4.0", "cc-by"),
    ("CC-BY-SA-4.0", "cc-by-sa"),
    ("CC-BY-NC-4.0", "cc-by-nc"),
)

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software."""
_MIT_END = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

#: Texts of licenses, whole and in the parts by which they are told.
TEXTS = (
    ("mit", ("free of charge", "copy of this software"), "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", ("deal in the software",), _MIT),
    ("mit", ("deal in the software",), f"{_MIT} {_MIT_END}"),
    ("bsd", ("binary forms",), "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-2-clause", ("binary forms", "reproduce the above"), f"{_BSD} {_BSD_END}"),
    ("bsd-3-clause", ("binary forms", "reproduce the above", "neither the name"), f"{_BSD} {_BSD_3} {_BSD_END}"),
    ("isc", ("distribute this software",), "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    (
        "isc",
        ("distribute this software", "with or without fee"),
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "apache-2.0",
        ("apache license version 2",),
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License.""",
    ),
    (
        "mpl-2.0",
        ("mozilla public license",),
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    (
        "zlib",
        ("origin of this software",),
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "unlicense",
        ("unencumbered software",),
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.""",
    ),
    (
        "bsl-1.0",
        ("machine executable object code",),
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including
the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
machine-executable object code generated by a source language processor.""",
    ),
)


def templates() -> tuple:
    """All templates but the phrases."""
    spdx = ((label, (f"identifier {name}",), f"SPDX-License-Identifier: {name}") for name, label in SPDX)
    return (*NOTICES, *NAMES, *spdx, *TEXTS)
