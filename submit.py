"""Script for ``spark-submit``; see ``layerwright/__main__.py``."""

import sys

from layerwright.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
