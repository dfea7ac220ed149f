from __future__ import annotations

import os
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))
# Python workers import the package wherever the tests were started.
os.environ["PYTHONPATH"] = ":".join(filter(None, [str(HERE.parents[1]), os.environ.get("PYTHONPATH")]))
