"""Sentences of licences and notices, for the licence scan.

Each is ``(priority, keyword, regex)`` under its label, in the order in which they are tried. A
regex is over lower-case words with single blanks between them; its keyword is in every match.
Written one by one from the public texts of the licences; fixed values.
"""

from __future__ import annotations

SIGNATURES: dict[str, tuple[tuple[int, str, str], ...]] = {
    "apache": (
        (2, "compliance with the license", "you may not use this file except in compliance with the license"),
        (2, "copy of the license", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
        (2, "on an as is basis", "software distributed under the license is distributed on an as is basis"),
        (2, "governing permissions", "see the license for the specific language governing permissions and limitations under the license"),
        (2, "contributor hereby grants", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
        (2, "contributor hereby grants", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license"),
        (2, "contributor license agreements", "licensed to the apache software foundation asf under one or more contributor license agreements"),
        (2, "notice text file", "if the work includes a notice text file as part of its distribution"),
        (3, "apache software foundation", "this product includes software developed (?:at|by) the apache software foundation"),
        (3, "terms and conditions for use", "terms and conditions for use reproduction and distribution"),
        (3, "apply the apache license", "how to apply the apache license to your work"),
        (4, "apache org licenses", "apache org licenses"),
        (4, "asl 2 0", "asl 2 0"),
    ),
    "mit": (
        (2, "subject to the following conditions", "to permit persons to whom the software is furnished to do so subject to the following conditions"),
        (2, "substantial portions", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
        (2, "deal in the software", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
        (2, "fitness for a particular purpose and noninfringement", "merchantability fitness for a particular purpose and noninfringement"),
        (2, "dealings in the software", "out of or in connection with the software or the use or other dealings in the software"),
        (3, "opensource org licenses mit", "opensource org licenses mit"),
        (3, "dual licensed", "dual licensed under the mit"),
        (4, "mit style", "mit style"),
        (4, "mit licensed", "mit licensed"),
    ),
    "json": (
        (2, "used for good", "the software shall be used for good not evil"),
    ),
    "x11": (
        (2, "x consortium", "except as contained in this notice the name of the x consortium shall not be used"),
    ),
    "bsd": (
        (2, "redistributions of source code", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        (2, "redistributions in binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
        (2, "copyright holders and contributors", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
        (2, "regents and contributors", "this software is provided by the regents and contributors as is"),
        (2, "procurement of substitute goods", "procurement of substitute goods or services loss of use data or profits or business interruption"),
        (3, "regents of the university", "the regents of the university of california all rights reserved"),
        (4, "bsd style", "bsd style"),
        (4, "bsd licensed", "bsd licensed"),
    ),
    "bsd-3": (
        (2, "endorse or promote", "may be used to endorse or promote products derived from this software without specific prior written permission"),
        (2, "names of its contributors", "the names of its contributors may not be used to endorse or promote"),
        (3, "opensource org licenses bsd 3", "opensource org licenses bsd 3 clause"),
    ),
    "bsd-2": (
        (3, "opensource org licenses bsd 2", "opensource org licenses bsd 2 clause"),
        (2, "views and conclusions", "the views and conclusions contained in the software and documentation are those of the authors"),
    ),
    "bsd-4": (
        (2, "following acknowledgement", "must display the following acknowledgement this product includes software developed by"),
    ),
    "gpl": (
        (2, "under the terms of the gnu general public", "under the terms of the gnu general public licen[cs]e as published by the free software foundation"),
        (2, "hope that it will be useful", "this program is distributed in the hope that it will be useful but without any warranty"),
        (2, "received a copy of the gnu general", "you should have received a copy of the gnu general public licen[cs]e along with"),
        (2, "verbatim copies of this license", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
        (2, "freedom to share", "are designed to take away your freedom to share and change"),
        (2, "free as in speech", "free as in speech not as in free beer"),
        (2, "work based on the program", "you may modify your copy or copies of the program or any portion of it thus forming a work based on the program"),
        (2, "machine readable", "accompany it with the complete corresponding machine readable source code"),
        (2, "user product", "if you convey an object code work under this section in or with or specifically for use in a user product"),
        (2, "anti circumvention", "protecting users legal rights from anti circumvention law"),
        (2, "linking exception", "gpl linking exception"),
        (2, "classpath exception", "classpath exception"),
        (3, "gnu org licenses gpl", "gnu org licenses gpl"),
        (3, "gnu org copyleft gpl", "gnu org copyleft gpl"),
        (3, "absolutely no warranty", "comes with absolutely no warranty"),
        (4, "gnu gpl", "gnu gpl"),
        (4, "gplv2", "gplv2"),
        (4, "gplv3", "gplv3"),
    ),
    "lgpl": (
        (2, "work that uses the library", "a work that uses the library"),
        (2, "received a copy of the gnu lesser", "you should have received a copy of the gnu lesser general public licen[cs]e along with"),
        (2, "received a copy of the gnu library", "you should have received a copy of the gnu library general public licen[cs]e along with"),
        (2, "under the terms of the gnu lesser", "under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation"),
        (2, "combined work", "you may convey a combined work under terms of your choice"),
        (2, "itself be a software library", "the modified work must itself be a software library"),
        (3, "gnu org licenses lgpl", "gnu org licenses lgpl"),
        (4, "lgplv2", "lgplv2"),
        (4, "lgplv3", "lgplv3"),
    ),
    "agpl": (
        (2, "interacting with it remotely", "all users interacting with it remotely through a computer network"),
        (2, "received a copy of the gnu affero", "you should have received a copy of the gnu affero general public licen[cs]e along with"),
        (2, "under the terms of the gnu affero", "under the terms of the gnu affero general public licen[cs]e"),
        (3, "gnu org licenses agpl", "gnu org licenses agpl"),
        (2, "network server software", "specifically designed to ensure cooperation with the community in the case of network server software"),
        (4, "agplv3", "agplv3"),
    ),
    "gfdl": (
        (2, "invariant sections", "with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
        (2, "copy distribute and or modify this document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
        (2, "functional and useful document", "make a manual textbook or other functional and useful document free in the sense of freedom"),
        (3, "gnu org licenses fdl", "gnu org licenses fdl"),
    ),
    "mpl": (
        (2, "this source code form", "this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
        (2, "mpl was not distributed", "if a copy of the mpl was not distributed with this file you can obtain one at"),
        (2, "incompatible with secondary licenses", "this source code form is incompatible with secondary licenses"),
        (2, "contents of this file are subject", "the contents of this file are subject to the mozilla public licen[cs]e"),
        (2, "initial developer of the original code", "the initial developer of the original code is"),
        (2, "larger work", "you may create and distribute a larger work under terms of your choice"),
        (3, "mozilla org mpl", "mozilla org mpl"),
    ),
    "epl": (
        (2, "accompanying program is provided", "the accompanying program is provided under the terms of this eclipse public licen[cs]e agreement"),
        (2, "program and the accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
        (2, "recipient s acceptance", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
        (2, "commercial contributor", "such contributor commercial contributor hereby agrees to defend and indemnify every other contributor"),
        (3, "eclipse org legal", "eclipse org legal epl"),
    ),
    "cddl": (
        (2, "subject to the terms of the common development", "the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
        (2, "include this cddl header", "when distributing covered code include this cddl header notice in each file"),
        (2, "cddl header start", "cddl header start"),
        (3, "opensolaris os licensing", "opensolaris os licensing"),
    ),
    "cpl": (
        (2, "terms of this common public", "the accompanying program is provided under the terms of this common public licen[cs]e"),
        (3, "opensource org licenses cpl", "opensource org licenses cpl"),
    ),
    "eupl": (
        (2, "licensed under the eupl", "licensed under the eupl"),
        (2, "work as defined below", "this european union public licen[cs]e .{0,40}? ?applies to the work as defined below"),
    ),
    "artistic": (
        (2, "standard version", "you may distribute verbatim forms of the source form of the standard version of this package"),
        (2, "artistic control", "the copyright holder maintains some semblance of artistic control over the development of the package"),
        (2, "under the artistic", "under the artistic licen[cs]e"),
        (3, "perl artistic", "perl artistic"),
    ),
    "boost": (
        (2, "machine executable object code", "solely in the form of machine executable object code generated by a source language processor"),
        (2, "boost org license 1 0", "boost org license 1 0 txt"),
    ),
    "isc": (
        (2, "appear in all copies", "with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
        (2, "author disclaims all warranties", "the software is provided as is and the author disclaims all warranties with regard to this software"),
        (2, "isc disclaims", "isc disclaims all warranties with regard to this software"),
    ),
    "zlib": (
        (2, "must not be misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
        (2, "altered source versions", "altered source versions must be plainly marked as such"),
        (2, "removed or altered from any source", "this notice may not be removed or altered from any source distribution"),
    ),
    "libpng": (
        (2, "png reference library", "the png reference library is supplied as is"),
        (2, "libpng versions", "libpng versions .{1,80}? are copyright"),
    ),
    "unlicense": (
        (2, "compile sell or distribute", "anyone is free to copy modify publish use compile sell or distribute this software"),
        (2, "dedicate any and all copyright interest", "dedicate any and all copyright interest in the software to the public domain"),
        (2, "relinquishment in perpetuity", "overt act of relinquishment in perpetuity of all present and future rights"),
        (3, "unlicense org", "unlicense org"),
    ),
    "wtfpl": (
        (2, "you just do what", "you just do what the .{1,12} you want to"),
        (3, "wtfpl net", "wtfpl net"),
    ),
    "beerware": (
        (2, "buy me a beer", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
        (2, "beer ware", "the beer ware licen[cs]e"),
        (4, "beerware", "beerware"),
    ),
    "openssl": (
        (2, "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
        (2, "eric young", "this product includes cryptographic software written by eric young"),
        (2, "openssl project", "the names openssl toolkit and openssl project must not be used to endorse"),
    ),
    "php": (
        (2, "includes php software", "this product includes php software freely available from"),
        (3, "php net license", "php net license"),
    ),
    "python": (
        (2, "psf hereby grants", "psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e"),
        (2, "between the python software foundation", "this license agreement is between the python software foundation psf and the individual or organization"),
        (2, "cnri hereby grants", "cnri hereby grants licensee a nonexclusive royalty free world wide licen[cs]e"),
        (2, "stichting mathematisch centrum", "stichting mathematisch centrum amsterdam"),
    ),
    "ruby": (
        (2, "give non standard executables", "give non standard executables non standard names"),
        (2, "same terms as ruby", "same terms as ruby(?: itself)?"),
    ),
    "perl": (
        (2, "under the same terms as perl", "(?:redistribute|modify) it (?:and or (?:modify|redistribute) it )?under the same terms as perl"),
    ),
    "postgresql": (
        (2, "without a written agreement", "for any purpose without fee and without a written agreement is hereby granted"),
        (2, "no obligations to provide maintenance", "has no obligations to provide maintenance support updates enhancements or modifications"),
    ),
    "ncsa": (
        (2, "deal with the software without restriction", "to deal with the software without restriction"),
        (2, "developed by the university of illinois", "developed by the university of illinois"),
    ),
    "curl": (
        (2, "to use copy modify and distribute this software for any purpose", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
        (3, "daniel haxx se", "daniel stenberg daniel haxx se"),
    ),
    "w3c": (
        (2, "w3c software", "w3c software (?:notice and|and document) (?:licen[cs]e|notice)"),
        (2, "w3c r software", "w3c r software licen[cs]e"),
        (3, "w3 org consortium legal", "w3 org consortium legal"),
    ),
    "ofl": (
        (2, "this font software is licensed", "this font software is licensed under the sil open font licen[cs]e"),
        (2, "reserved font name", "with reserved font names?"),
        (2, "may be sold by itself", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
        (3, "scripts sil org ofl", "scripts sil org ofl"),
    ),
    "ms-pl": (
        (2, "governs use of the accompanying software", "this license governs use of the accompanying software if you use the software you accept this license"),
    ),
    "osl": (
        (2, "licensed under the open software", "licensed under the open software licen[cs]e version 3 0"),
        (2, "external deployment", "you must treat any external deployment by you of the original work"),
    ),
    "afl": (
        (2, "licensed under the academic free", "licensed under the academic free licen[cs]e version [123] [01]"),
    ),
    "odbl": (
        (2, "produced work", "if you publicly use a produced work you must include a notice"),
        (2, "derivative database", "any derivative database that you publicly use must be only under the terms of"),
        (3, "opendatacommons org licenses odbl", "opendatacommons org licenses odbl"),
    ),
    "odc-by": (
        (3, "opendatacommons org licenses by", "opendatacommons org licenses by"),
    ),
    "pddl": (
        (3, "opendatacommons org licenses pddl", "opendatacommons org licenses pddl"),
    ),
    "cecill": (
        (2, "governed by the cecill", "this software is governed by the cecill"),
        (3, "cecill info", "cecill info"),
    ),
    "sspl": (
        (2, "functionality of the program or modified version available to third parties", "make the functionality of the program or modified version available to third parties as a service"),
        (2, "service source code", "service source code means the corresponding source for the program"),
    ),
    "busl": (
        (2, "additional use grant", "additional use grant"),
        (2, "change date", "change date .{1,40}? change license"),
        (2, "non production use", "the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ),
    "elastic": (
        (2, "hosted or managed service", "you may not provide the software to third parties as a hosted or managed service"),
        (2, "license key functionality", "you may not move change disable or circumvent the license key functionality"),
    ),
    "commons-clause": (
        (2, "commons clause", "commons clause(?: licen[cs]e condition)?"),
        (2, "right to sell the software", "does not grant to you the right to sell the software"),
    ),
    "polyform": (
        (2, "polyform", "polyform (?:noncommercial|small business|strict|shield|perimeter) licen[cs]e"),
        (2, "any noncommercial purpose is", "any noncommercial purpose is a permitted purpose"),
    ),
    "cc-by": (
        (2, "give appropriate credit", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
        (2, "copy and redistribute the material", "copy and redistribute the material in any medium or format"),
        (2, "remix transform and build upon", "remix transform and build upon the material"),
        (3, "creativecommons org licenses by", "creativecommons org licenses by(?: [1-4] [05])?"),
        (3, "licensed under a creative commons attribution", "licensed under a creative commons attribution(?: [1-4] [05])?(?: international| unported)?"),
    ),
    "cc-by-sa": (
        (2, "distribute your contributions under the same", "you must distribute your contributions under the same license as the original"),
        (3, "creativecommons org licenses by sa", "creativecommons org licenses by sa(?: [1-4] [05])?"),
        (3, "attribution sharealike", "attribution sharealike(?: [1-4] [05])?"),
    ),
    "cc-by-nc": (
        (2, "use the material for commercial purposes", "you may not use the material for commercial purposes"),
        (3, "creativecommons org licenses by nc", "creativecommons org licenses by nc(?: [1-4] [05])?"),
    ),
    "cc-by-nc-sa": (
        (3, "creativecommons org licenses by nc sa", "creativecommons org licenses by nc sa(?: [1-4] [05])?"),
    ),
    "cc-by-nc-nd": (
        (3, "creativecommons org licenses by nc nd", "creativecommons org licenses by nc nd(?: [1-4] [05])?"),
    ),
    "cc-by-nd": (
        (2, "distribute the modified material", "if you remix transform or build upon the material you may not distribute the modified material"),
        (3, "creativecommons org licenses by nd", "creativecommons org licenses by nd(?: [1-4] [05])?"),
    ),
    "cc0": (
        (2, "waiving all of his or her rights", "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
        (2, "affirmer hereby overtly", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
        (3, "creativecommons org publicdomain zero", "creativecommons org publicdomain zero(?: 1 0)?"),
        (3, "no rights reserved", "no rights reserved"),
    ),
    "public-domain": (
        (2, "no copyright is claimed", "no copyright is claimed"),
        (2, "work of the united states government", "(?:is|as) a work of the united states government"),
        (2, "free of known copyright", "free of known copyright restrictions"),
        (3, "creativecommons org publicdomain mark", "creativecommons org publicdomain mark"),
        (2, "disclaims copyright to this source code", "the author disclaims copyright to this source code"),
        (2, "may you do good and not evil", "may you do good and not evil"),
    ),
    "open-government": (
        (2, "open government", "open government licen[cs]e(?: v ?[123](?: 0)?)?"),
        (2, "public sector information licensed", "contains public sector information licensed under"),
    ),
    "proprietary": (
        (2, "trade secret", "contains? (?:confidential and |proprietary )?(?:information and )?trade secrets? (?:information )?(?:of|belonging to)"),
        (2, "strictly prohibited", "(?:copying|reproduction|distribution|disclosure|use|reproduction or distribution) .{0,60}? ?is strictly prohibited"),
        (2, "not be reproduced", "may not be reproduced (?:or|distributed|copied|in whole)"),
        (2, "express written permission", "without (?:the )?(?:prior )?express written permission"),
        (2, "prior written consent", "without (?:the )?prior written consent"),
        (2, "no part of this", "no part of this (?:publication|book|work|document|software|website) may be (?:reproduced|copied|stored)"),
        (2, "reverse engineer", "(?:not|shall not|may not) .{0,40}? ?(?:decompile|disassemble)? ?(?:or )?reverse engineer"),
        (2, "licensed not sold", "the software is licensed not sold"),
        (2, "by installing", "by installing (?:copying )?(?:or )?(?:otherwise )?(?:using )?the software you agree"),
        (2, "for internal use only", "for internal use only"),
        (2, "company confidential", "company confidential"),
        (2, "personal non commercial use", "for (?:your )?personal non commercial use(?: only)?"),
        (2, "evaluation purposes only", "for evaluation purposes only"),
        (3, "subscription agreement", "(?:software|service|master) subscription agreement"),
        (3, "terms of service", "(?:subject to|agree to|governed by)(?: our| the| these)? terms of service"),
        (3, "restricted rights", "(?:government )?restricted rights(?: legend)?"),
        (3, "patent pending", "patent pending"),
    ),
    "notice": (
        (3, "registered trademark", "(?:is a|are) registered trademarks? of"),
        (3, "trademarks are the property", "(?:all )?(?:other )?trademarks are the property of their respective owners"),
        (3, "third party notices", "third party notices"),
        (3, "licensing information", "licensing information"),
        (3, "for copying permission", "see (?:the file )?(?:copying|license) for copying permission"),
        (4, "license txt", "license txt"),
        (4, "license md", "license md"),
    ),
    "open-source": (
        (3, "osi approved", "osi approved(?: licen[cs]e)?"),
        (3, "free software license", "free software license"),
        (3, "opensource org licenses", "opensource org licenses"),
        (4, "open sourced", "open sourced"),
        (4, "source available", "source available"),
    ),
}
