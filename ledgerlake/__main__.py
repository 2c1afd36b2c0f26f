import sys

from ledgerlake.cli import main

sys.exit(main())
