"""License wording as templates: words, optional regions and replaceable ones.

Markup: <<begin>> ... <<end>> encloses wording that may be missing as a whole;
<<var 1-8>> stands for 1 to 8 words of any kind; <<unless a b>> refuses a text in which
one of these words comes next. All other words are mandatory.
"""

from __future__ import annotations

# Label, name and wording of each template.
TEMPLATES = (
    (
        "mit",
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice <<begin>>(including the next "
        "paragraph)<<end>> shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "<<var 1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
    (
        "isc",
        "isc-text",
        "Permission to use, copy, modify, and<<begin>>/or<<end>> distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var 1-8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
        "<<var 1-8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "bsd",
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: <<begin>>1.<<end>> Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. <<begin>>2.<<end>> "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. "
        "<<begin>>3.<<end>> <<begin>>Neither the name of <<var 1-12>> nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written "
        "permission.<<end>> THIS SOFTWARE IS PROVIDED BY <<var 1-12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var 1-12>> BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
        "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "apache-2",
        "apache-2-notice",
        "Licensed under the Apache License, Version 2.0 <<begin>>(the \"License\"); you may not use <<var 1-4>> "
        "except in compliance with the License.<<end>>",
    ),
    (
        "gpl-3",
        "gpl-3-notice",
        "under the <<begin>>terms of the<<end>> GNU General Public License <<begin>>as published by the Free "
        "Software Foundation, either<<end>> version 3",
    ),
    (
        "apache-2",
        "apache-2-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at <<var 1-2>> www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "mpl-2",
        "mpl-2-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at <<var 1-2>> mozilla.org/MPL/2.0/",
    ),
    (
        "gpl-2",
        "gpl-2-header",
        "is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "<<begin>>version 2<<end>> as published by the Free Software Foundation; <<begin>>either<<end>> version 2 of the "
        "License<<begin>>, or (at your option) any later version<<end>>.",
    ),
    (
        "gpl-3",
        "gpl-3-header",
        "is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "<<begin>>version 3<<end>> as published by the Free Software Foundation, <<begin>>either<<end>> version 3 of the "
        "License<<begin>>, or (at your option) any later version<<end>>.",
    ),
    (
        "lgpl-2.1",
        "lgpl-2.1-header",
        "is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; <<begin>>either<<end>> version 2.1 of the "
        "License<<begin>>, or (at your option) any later version<<end>>.",
    ),
    (
        "lgpl-3",
        "lgpl-3-header",
        "is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, <<begin>>either<<end>> version 3 of the "
        "License<<begin>>, or (at your option) any later version<<end>>.",
    ),
    (
        "gpl-2",
        "gpl-2-head",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. "
        "<<begin>><<var 1-14>><<end>> Everyone is permitted to copy and distribute verbatim copies of this license "
        "document, but changing it is not allowed.",
    ),
    (
        "gpl-3",
        "gpl-3-head",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
        "<<begin>><<var 1-6>><<end>> Everyone is permitted to copy and distribute verbatim copies of this license "
        "document, but changing it is not allowed.",
    ),
    (
        "lgpl-2.1",
        "lgpl-2.1-head",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, "
        "Inc. <<begin>><<var 1-14>><<end>> Everyone is permitted to copy and distribute verbatim copies of this license "
        "document, but changing it is not allowed.",
    ),
    (
        "lgpl-3",
        "lgpl-3-head",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
        "<<begin>><<var 1-6>><<end>> Everyone is permitted to copy and distribute verbatim copies of this license "
        "document, but changing it is not allowed.",
    ),
    ("gpl-2", "gpl-2-name", "GNU General Public License v2.0 <<begin>>only<<end>> <<begin>>or later<<end>>"),
    ("gpl-3", "gpl-3-name", "GNU General Public License v3.0 <<begin>>only<<end>> <<begin>>or later<<end>>"),
    (
        "unlicense",
        "unlicense-text",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
        "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        "present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "zlib",
        "zlib-text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will "
        "<<var 1-8>> be held liable for any damages arising from the use of this software. Permission is granted to "
        "anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: <<begin>>1.<<end>> The origin of this software "
        "must not be misrepresented; you must not claim that you wrote the original software. If you use this software "
        "in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "<<begin>>2.<<end>> Altered source versions must be plainly marked as such, and must not be misrepresented as "
        "being the original software. <<begin>>3.<<end>> This notice may not be removed or altered from any source "
        "distribution.",
    ),
    (
        "bsl-1",
        "bsl-1-text",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
        "notices in the Software and this entire statement, including the above license grant, this restriction and "
        "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all "
        "derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT "
        "HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
    (
        "cc-by-nc",
        "cc-by-nc-notice",
        "Licensed under <<begin>>the<<end>> CC BY-NC <<unless sa nd>> <<begin>><<var 1-2>><<end>>",
    ),
    ("cc-by-nc-sa", "cc-by-nc-sa-notice", "Licensed under <<begin>>the<<end>> CC BY-NC-SA <<begin>><<var 1-2>><<end>>"),
    ("cc-by-nc-nd", "cc-by-nc-nd-notice", "Licensed under <<begin>>the<<end>> CC BY-NC-ND <<begin>><<var 1-2>><<end>>"),
    ("mit", "mit-notice", "Released under the MIT License"),
    ("all-rights-reserved", "rights-notice", "All rights reserved"),
)
