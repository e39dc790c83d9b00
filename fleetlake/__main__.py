from fleetlake.cli import main

main()
