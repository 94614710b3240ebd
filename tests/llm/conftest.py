import os
import sys

# the folder is a package, since both folders have a test_quality.py; its tests import each other by name
sys.path.append(os.path.dirname(os.path.abspath(__file__)))
