"""Entry file for spark-submit; see ``millrace/__main__.py``."""

from millrace.__main__ import main

if __name__ == "__main__":
    main()
