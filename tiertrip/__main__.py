import sys

from tiertrip.plans.cli import main

sys.exit(main())
