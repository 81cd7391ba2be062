from statflow.jobs import main

main()
