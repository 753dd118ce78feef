import sys

from strataframe.cli import main

sys.exit(main())
