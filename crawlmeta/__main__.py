import sys

from crawlmeta.cli import main

sys.exit(main())
