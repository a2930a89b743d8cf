"""Entry for ``spark-submit``: same arguments as ``python -m skyledger``."""

from skyledger.__main__ import main

if __name__ == "__main__":
    main()
