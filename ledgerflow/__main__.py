from ledgerflow.plans.daily_run import main

main()
