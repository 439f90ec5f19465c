"""Texts by which files state common licences: (SPDX id, text) rows.

Names, titles, headers and short licence texts are fixed values of the public
licences. One-line statements are made from the names by rule. The long licences
(GNU family, Apache, Mozilla, Creative Commons) are known by their titles,
standard headers and names; their bodies are not repeated here.
"""

from __future__ import annotations

# SPDX id and the names in use.
NAMES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3 License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License", "Apache Software License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD 2-Clause Simplified License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD 3-Clause New or Revised License", "New BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, v. 2.0"],
    "GPL-1.0-or-later": ["GNU General Public License", "GNU GPL"],  # no version named: any version
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2 License"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3 License"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1 License"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3 License"],
    "MIT": ["MIT License", "MIT", "Expat License"],
    "MPL-2.0": ["Mozilla Public License Version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "WTFPL": ["Do What The Fuck You Want To Public License", "WTFPL License"],
    "Zlib": ["zlib License", "zlib/libpng License"],
}
STATEMENTS = [
    "Licensed under the {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "This project is licensed under the terms of the {} - see the LICENSE file for details.",
    "This software is distributed under the {}. All rights reserved. Copyright.",
]
GNU_HEADER = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
GNU = {
    "AGPL-3.0": ("GNU Affero General Public License", "3", "Version 3, 19 November 2007"),
    "GPL-2.0": ("GNU General Public License", "2", "Version 2, June 1991"),
    "GPL-3.0": ("GNU General Public License", "3", "Version 3, 29 June 2007"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1", "Version 2.1, February 1999"),
    "LGPL-3.0": ("GNU Lesser General Public License", "3", "Version 3, 29 June 2007"),
}
APACHE_GRANT = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
APACHE_LIMITS = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
    "language governing permissions and limitations under the License."
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
BSD_REST = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
USE_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEXTS = [
    ("0BSD", USE_GRANT + "."),
    ("0BSD", f"{USE_GRANT}. {ISC_REST}"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", APACHE_GRANT),
    ("Apache-2.0", APACHE_LIMITS),
    ("Apache-2.0", f"{APACHE_GRANT} {APACHE_LIMITS}"),
    (
        "Apache-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
        "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You "
        f"under the Apache License, Version 2.0. {APACHE_GRANT} {APACHE_LIMITS}",
    ),
    ("BSD-2-Clause", f"{BSD_TWO} {BSD_REST}"),
    ("BSD-2-Clause", BSD_TWO),
    ("BSD-3-Clause", f"{BSD_TWO} {BSD_THREE} {BSD_REST}"),
    ("BSD-3-Clause", f"{BSD_TWO} {BSD_THREE}"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License. Redistribution and use in source and binary forms are permitted."),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("ISC", "Released under the ISC License. Permission to use, copy, modify and distribute is granted."),
    ("ISC", USE_GRANT + ISC_NOTICE),
    ("ISC", f"{USE_GRANT}{ISC_NOTICE} {ISC_REST}"),
    ("MIT", MIT_GRANT),
    ("MIT", f"{MIT_GRANT} {MIT_REST}"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
]


def templates() -> list[tuple[str, str]]:
    """All (license, text) rows, without repeats; the licence's first name comes last."""
    rows = list(TEXTS)
    for spdx, (name, version, dated) in GNU.items():
        rows.append((spdx, f"{name} {dated}"))
        rows += [(spdx, GNU_HEADER.format(thing=thing, name=name, version=version)) for thing in ("program", "library", "file")]
    for spdx, names in NAMES.items():
        ids = [spdx, f"{spdx}-only", f"{spdx}-or-later"] if spdx in GNU else [spdx]
        rows += [(spdx, f"SPDX-License-Identifier: {i}") for i in ids]
        rows += [(spdx, statement.format(name)) for name in names for statement in STATEMENTS]
        rows += [(spdx, name) for name in names[::-1] if name != "MIT"]
    return list(dict.fromkeys(rows))
