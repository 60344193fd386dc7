"""``python -m sluice admissions|admissions_reject|smart_home --input ... --output ...``"""

from sluice.plans.runs import main

main()
