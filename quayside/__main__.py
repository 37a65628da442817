import sys

from quayside.plans.cli import main

sys.exit(main())
