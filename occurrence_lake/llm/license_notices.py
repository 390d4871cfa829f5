"""Wordings of common licence notices: fixed values, in the licences' own
words.

One entry: label, mandatory key phrase, notice.  Notices are the parts that
projects copy into files: standard headers, the licence's heading, the
opening grant and SPDX lines.
"""

#: (label, key phrase, notice)
NOTICES = [
    # Apache License 2.0
    ("apache-2.0", "licensed under the apache license version 2 0",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at"),
    ("apache-2.0", "apache license version 2 0", "Apache License Version 2.0"),
    ("apache-2.0", "spdx license identifier apache 2 0", "SPDX-License-Identifier: Apache-2.0"),
    # GNU General Public License
    ("gpl-3.0", "gnu general public license as published by the free software foundation either version 3",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3.0", "gnu general public license version 3", "GNU GENERAL PUBLIC LICENSE Version 3"),
    ("gpl-3.0", "spdx license identifier gpl 3 0", "SPDX-License-Identifier: GPL-3.0"),
    ("gpl-2.0", "gnu general public license as published by the free software foundation either version 2",
     "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-2.0", "gnu general public license version 2", "GNU GENERAL PUBLIC LICENSE Version 2"),
    ("gpl-2.0", "spdx license identifier gpl 2 0", "SPDX-License-Identifier: GPL-2.0"),
    # GNU Lesser and Affero General Public License
    ("lgpl-3.0", "gnu lesser general public license as published by the free software foundation either version 3",
     "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl-3.0", "gnu lesser general public license version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3"),
    ("lgpl-3.0", "spdx license identifier lgpl 3 0", "SPDX-License-Identifier: LGPL-3.0"),
    ("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1",
     "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "gnu lesser general public license version 2 1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1"),
    ("lgpl-2.1", "spdx license identifier lgpl 2 1", "SPDX-License-Identifier: LGPL-2.1"),
    ("agpl-3.0", "gnu affero general public license as published by the free software foundation either version 3",
     "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software "
     "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl-3.0", "gnu affero general public license version 3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3"),
    ("agpl-3.0", "spdx license identifier agpl 3 0", "SPDX-License-Identifier: AGPL-3.0"),
    # MIT
    ("mit", "permission is hereby granted free of charge",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
     "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "mit license", "released under the MIT License"),
    ("mit", "the mit license mit", "The MIT License (MIT)"),
    ("mit", "spdx license identifier mit", "SPDX-License-Identifier: MIT"),
    # BSD
    ("bsd", "redistribution and use in source and binary forms",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-2-clause", "spdx license identifier bsd 2 clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission",
     "the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause", "SPDX-License-Identifier: BSD-3-Clause"),
    # ISC
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
     "above copyright notice and this permission notice appear in all copies."),
    ("isc", "spdx license identifier isc", "SPDX-License-Identifier: ISC"),
    # Mozilla and Eclipse Public License
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
     "file, You can obtain one at"),
    ("mpl-2.0", "mozilla public license version 2 0", "Mozilla Public License Version 2.0"),
    ("mpl-2.0", "spdx license identifier mpl 2 0", "SPDX-License-Identifier: MPL-2.0"),
    ("epl-2.0", "eclipse public license v 2 0", "Eclipse Public License - v 2.0"),
    ("epl-2.0", "spdx license identifier epl 2 0", "SPDX-License-Identifier: EPL-2.0"),
    # zlib, Boost, Unlicense
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software",
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
     "arising from the use of this software."),
    ("zlib", "spdx license identifier zlib", "SPDX-License-Identifier: Zlib"),
    ("bsl-1.0", "boost software license version 1 0", "Boost Software License - Version 1.0"),
    ("bsl-1.0", "spdx license identifier bsl 1 0", "SPDX-License-Identifier: BSL-1.0"),
    ("unlicense", "free and unencumbered software released into the public domain",
     "This is free and unencumbered software released into the public domain."),
    # Creative Commons
    ("cc-by-nc", "cc by nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "cc by sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "creative commons attribution 4 0 international", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0-1.0", "cc0 1 0 universal", "CC0 1.0 Universal"),
    ("cc0-1.0", "spdx license identifier cc0 1 0", "SPDX-License-Identifier: CC0-1.0"),
]
