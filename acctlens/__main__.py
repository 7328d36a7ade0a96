import sys

from acctlens.build import main

sys.exit(main())
