"""python -m codexloom"""

import sys

from codexloom.cli import main

sys.exit(main())
